from __future__ import annotations

import random

import pytest

from tallyspark.llm import secrets


def _corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        key = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40])))
        add = [
            f"password={key}",
            f'token = "{key}"',
            "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
            "".join(rng.choice("aeioustrnl") for _ in range(rng.randrange(16, 30))),
            "4" + "".join(rng.choice("0123456789") for _ in range(15)),
            f"https://example.org/path/to/{words[0]}-{words[1]}-{words[2]}-{words[3]}",
        ][i % 6]
        words.insert(30, add)
        rows.append((i, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(_corpus(600, 1), "doc_id long, text string")


def test_held_out_findings_are_judged_right(corpus):
    from pyspark.sql import functions as F

    judged = secrets.stored(secrets.features(corpus, secrets.stored(secrets.planted(corpus))))
    mine = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    model = secrets.fit(judged.filter(mine))
    rows = secrets.judge(judged.filter(~mine), model).collect()
    right = sum((r["probability"] >= secrets.KEEP) == bool(r["label"]) for r in rows)
    assert len(rows) >= 2000 and right / len(rows) >= 0.97
    beside = [r["label"] for r in rows if r["key_beside"]]  # the key word does not give the label away
    assert 0.2 <= sum(beside) / len(beside) <= 0.8
    rule = sum(bool(r["key_beside"]) == bool(r["label"]) for r in rows)
    assert right >= rule + 0.1 * len(rows)


def test_look_alikes_beside_key_words_are_removed(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randrange(4, 9))) for _ in range(200)]
    name = lambda sep: sep.join(rng.choice(words) for _ in range(3))
    rows = []
    for i in range(400):
        look = [f"password={name('-')}", f'secret = "{name("_")}"', f"token: get_{name('_')}()", "api_key=${" + name("_").upper() + "}"][i % 4]
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        prose = " ".join(rng.choice(words) for _ in range(40))
        rows.append((i, f"{prose} {look if i % 2 or i % 4 == 0 else 'password=' + key} {prose}"))
    got = secrets.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    said = {r["doc_id"]: r["is_secret"] for r in got}
    look = [i for i in range(400) if i % 4 != 2]
    assert len(said) == 400 and all(said[i] for i in range(2, 400, 4))
    assert sum(said[i] for i in look) <= 0.03 * len(look)


def test_labelled_findings_of_the_caller(spark, corpus):
    from pyspark.sql import functions as F

    hexed = secrets.findings(corpus).withColumn("label", F.col("value").rlike("^[0-9a-f]+$").cast("int"))
    got = secrets.report(corpus, labelled=hexed).filter("is_secret").collect()
    assert {r["doc_id"] % 6 for r in got} <= {0, 1, 4} and len(got) >= 200
    none = secrets.report(corpus, labelled=hexed.limit(0)).collect()
    assert none and all(r["probability"] == 1.0 for r in none)


def test_report_and_plan(corpus):
    got = secrets.report(corpus)
    assert got.columns == ["doc_id", "token_no", "run_no", "n_chars", "value_sha256", "probability", "is_secret"]
    rows = got.collect()
    found = {r["doc_id"] for r in rows if r["is_secret"]}
    want = {i for i in range(600) if i % 6 < 3}
    assert len(found & want) >= 0.97 * len(want) and len(found - want) <= 10, (len(found & want), len(found - want))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_findings_context_and_several_in_one_token(spark):
    docs = spark.createDataFrame([(1, "my api_key: k1=abcdefgh12345678;k2=ABCDEFGH12345678== next"), (2, None), (3, ""), (4, "z" * 50_000)], "doc_id long, text string")
    rows = secrets.findings(docs).orderBy("doc_id", "place", "ord").collect()
    assert [(r["doc_id"], r["place"], r["ord"], r["value"][:16], r["before"][:3], r["beside"], r["after"]) for r in rows] == [
        (1, 2, 0, "abcdefgh12345678", "k1=", "my api_key:", "next"),
        (1, 2, 1, "ABCDEFGH12345678", "k1=", "my api_key:", "next"),
        (4, 0, 0, "z" * 16, "", "", ""),
    ]


def test_odd_rows_and_empty_table(odd, no_docs):
    assert all(0 <= r["probability"] <= 1 for r in secrets.report(odd).collect())
    assert secrets.report(no_docs).collect() == []


def test_scoring_works_in_a_session_that_has_used_observations(spark, corpus):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("rows")
    corpus.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 600
    assert secrets.report(corpus).count() == len(secrets.report(corpus).collect())


@pytest.mark.parametrize(
    "text, value",
    [
        ("password=hunter2xyz", "hunter2xyz"),
        ("pwd: Tr0ub4dor&3!kX.9z", "Tr0ub4dor&3!kX.9z"),
        ("the token = ab.cd.ef, then", "ab.cd.ef"),
        ("secret :a:b:c", "a:b:c"),
        ('"api_key":"k$1",', "k$1"),
        ("x=1;password=abcdefgh12345678!$z;y=2", "abcdefgh12345678!$z"),
        ("auth_token='two words here' next", "two words here"),
        ("PASSWORD=x", "x"),
        ("postgres://admin:Tr0ub4dor@db.example/x", "Tr0ub4dor"),
        ("curl -u admin:S3cr3t! host", "S3cr3t!"),
        ("the passphrase is Xk9!pQ2z ok", "Xk9!pQ2z"),
        ("Authorization: Basic dXNlcjpwYXNz end", "dXNlcjpwYXNz"),
        ('"Authorization": "Bearer abc.def" x', "abc.def"),
        ("secret='a b \"c' d", 'a b "c'),
        ('token = "' + " ".join(f"word{i}" for i in range(3000)) + '" "tail"', " ".join(f"word{i}" for i in range(3000))),
    ],
)
def test_whole_values_assigned_to_key_words_are_findings(spark, text, value):
    rows = secrets.findings(spark.createDataFrame([(1, f"so {text}")], "doc_id long, text string")).collect()
    assert [r["value"] for r in rows if r["assigned_whole"]] == [value]


def test_other_words_give_no_findings(spark):
    rows = secrets.findings(spark.createDataFrame([(1, "the password was lost: no one = x knows"), (2, "secret: "), (3, "a=b")], "doc_id long, text string"))
    assert rows.collect() == []


def test_several_quoted_values_end_at_their_own_quotes(spark):
    text = 'api_key="one" secret="two three" pwd=\'four "five six\' token="open end'
    rows = secrets.findings(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("place").collect()
    assert [r["value"] for r in rows] == ["one", "two three", 'four "five six', "open"]


def test_many_open_quotes_in_a_long_text(spark):
    text = " ".join(f"password=\"a{i} b{i}\" it's" for i in range(20_000))
    found = secrets.findings(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert found.filter("assigned_whole and value rlike '^a[0-9]+ b[0-9]+$'").count() == 20_000


def test_copies_do_not_push_distinct_findings_out_of_the_fit(corpus, monkeypatch):
    from pyspark.sql import functions as F

    own = secrets.findings(corpus).withColumn("label", (F.col("doc_id") % 6 < 3).cast("int"))
    judged = secrets.features(corpus, own).cache()
    n = {r["label"]: r["count"] for r in judged.groupBy("label").count().collect()}
    copied = judged.limit(40).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(99)))).drop("copy")
    sizes = []
    kept = secrets.stored

    def seen(df):
        out = kept(df)
        sizes.append({r["label"]: r["count"] for r in out.groupBy("label").count().collect()})
        return out

    monkeypatch.setattr(secrets, "stored", seen)
    assert secrets.fit(judged.unionByName(copied), per_class=10_000) is not None
    assert sizes[0] == n
