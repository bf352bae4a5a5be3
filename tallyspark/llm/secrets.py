"""Secret scan with a random forest that removes false positives.

Every unbroken run of 16 or more key-like characters is a finding, and so are the whole value assigned to a key word, the
password of an address or of a user option, and what follows an authorisation scheme, whatever their length and
characters. A random forest, trained on labelled findings, judges them by their length, the transitions between character
classes, how much of them dictionary words cover (words that enough of the documents hold), the path or address they stand
in, and the words beside them. Only DataFrame functions and the JVM's random forest are used.

Labelled findings come from the caller, or are planted (:func:`planted`): values made as secrets or as their look-alikes
(names, references, placeholders, digests) in contexts that both share, so that a key word alone decides nothing.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import LOWER, UPPER, scratch, small, stored

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
PER_CLASS = 10_000  # labelled findings of either class in the fit, at most
PLANTS = 8000  # planted lines, half of them with a secret
SAMPLE_DOCS = 2000  # documents that words for planted lines are taken from, at most
VOCABULARY = 2000  # such words, at most
MIN_DOCS = 5  # documents that hold a dictionary word, at least
WORD = 4  # letters of a dictionary word, at least
TREES, DEPTH, SEED = 40, 6, 7
KEEP = 0.5  # probability from which a finding is a secret

KEY_WORDS = r"(?i)(passw|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
OTHER_WORDS = r"(?i)(sha\d*|md5|commit|hash|uuid|guid|checksum|digest|version|isbn|order|card|phone)"
SCHEMES = "basic|bearer|digest|negotiate|apikey"
_USER_INFO = r"://[^/\s:@]*+:([^/\s]+)@"  # a password in an address
_USER_OPTION = r"""^["']?[^:\s"']++:(.+?)["']?$"""  # the token behind -u or --user
_ASKS = r"|(?:^|\s)(?:-u|--user|--proxy-user)\s|://[^/\s:@]*+:$"  # context of such a password
_ASSIGNS = KEY_WORDS + r"""\w*+['"]?(?:\s*+[:=]|\s++is\s)"""
# An assignment in a token: its head (a mark stands for a key word in the tokens before) and its value, which ends at its
# closing quote, before the next assignment, or with the token.
_MARK = "\x01"
_HEAD = rf"""(?:{_MARK}|{KEY_WORDS[4:]}\w*+['"]?[:=])[:=>]*+"""
_VALUE = rf"""(?i)({_HEAD})("[^"]++"|'[^']++'|.+?(?=[;&,]\w++['"]?[:=]|[;,]*+$))"""
# A value that is a list of named runs only: the runs are findings already.
_NAMED_RUN = r"\w++[:=][A-Za-z0-9+/_-]{16,}+={0,2}(?:[;&,]|$)"

FEATURES = (
    "length class_runs vowel_runs distinct digits uppers coverage slashes dots in_url in_address key_beside other_beside assigned quoted".split()
)


def _tokens(text: Column) -> Column:
    """White-space separated tokens of the whole text."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", " " * 5), " "), "")


def _closing(hits: Column) -> Column:
    """The places ``hits`` in tokens ``t`` as (i, double, single): the next tokens that hold the quotes of token i.

    By one sort of hits and quotes, not by a search for each hit.
    """
    spots = []
    for k, quote in enumerate("\"'"):
        at = F.filter(F.transform("t", lambda x, i: F.when(x.contains(quote), i)), lambda i: i.isNotNull())  # noqa: B023
        spots.append(F.zip_with(at, F.slice(at, 2, F.size(at)), lambda i, j: F.struct(i.alias("i"), F.lit(k).alias("k"), j.alias("j"))))  # noqa: B023
    own = F.transform(hits, lambda i: F.struct(i.alias("i"), F.lit(2).alias("k"), F.lit(None).cast("int").alias("j")))
    line = F.array_sort(F.concat(*spots, own))
    none = F.lit(None).cast("struct<i:int,k:int,j:int>")
    ones = F.zip_with(line, F.concat(F.array(none), line), lambda x, p: F.struct(x.alias("x"), p.alias("p")))
    twos = F.zip_with(ones, F.concat(F.array(none, none), line), lambda z, q: F.struct(z["x"].alias("x"), z["p"].alias("p"), q.alias("q")))
    of = lambda z, o, k: F.when((z[o]["i"] == z["x"]["i"]) & (z[o]["k"] == k), z[o]["j"])
    return F.transform(
        F.filter(twos, lambda z: z["x"]["k"] == 2),
        lambda z: F.struct(z["x"]["i"].alias("i"), F.coalesce(of(z, "p", 0), of(z, "q", 0)).alias("double"), of(z, "p", 1).alias("single")),
    )


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, place, ord, value, before, beside, after): each run, its token number, what stands before it in its token,
    the two tokens to its left and the one to its right; then (``assigned_whole``) each value assigned to a key word and
    each password of an address or user option that is more or less than a run, without its quotes. A quoted value ends at
    its closing quote however far away that is. Null and empty texts have none.
    """
    text = F.col(text_col)  # plain searches first: few texts need the other two patterns
    assigns = text.rlike(_ASSIGNS) | (text.contains("://") & text.rlike(_USER_INFO)) | (text.contains("-u") & text.rlike(r"(?:^|\s)(?:-u|--user|--proxy-user)\s"))
    tok = docs.select(F.col(id_col).alias("doc_id"), _tokens(text).alias("t"), F.coalesce(assigns, F.lit(False)).alias("assigns"))
    run = lambda x: (F.length(x) >= 16) & x.rlike(RUN)
    named = lambda i: F.when(i >= 1, F.get("t", i - 1)).otherwise("")
    valued = lambda z: z["x"].rlike(rf"(?i){_HEAD}.|{_USER_INFO}") | _assigned_before(z["x"], z["l"], z["l2"]) | _user_option(z["x"], z["l"])
    odd = lambda x, quote: (F.length(x) - F.length(F.translate(x, quote, ""))) % 2 == 1
    # Tokens with the two before them: a look at another token inside the lambda would split the text anew for each token.
    blank = F.array(F.lit(""))
    pairs = F.zip_with("t", F.concat(blank, "t"), lambda x, l: F.struct(x.alias("x"), l.alias("l")))
    threes = F.zip_with(pairs, F.concat(blank, blank, "t"), lambda z, l2: F.struct(z["x"].alias("x"), z["l"].alias("l"), l2.alias("l2")))
    valued_at = F.filter(F.transform(threes, lambda z, i: F.when(valued(z), i)), lambda i: i.isNotNull())
    runs_at = F.filter(F.transform("t", lambda x, i: F.when(run(x), i)), lambda i: i.isNotNull())
    hits = F.array_sort(F.array_union(runs_at, F.when(F.col("assigns"), valued_at).otherwise(F.array().cast("array<int>"))))
    held = tok.withColumn("hits", hits).filter(F.size("hits") > 0)
    plainly = F.transform("hits", lambda i: F.struct(i.alias("i"), *[F.lit(None).cast("int").alias(n) for n in ("double", "single")]))
    held = held.withColumn("hits", F.when(F.col("assigns"), _closing(F.col("hits"))).otherwise(plainly))
    upto = lambda i, j: F.when(j.isNull(), "").otherwise(F.array_join(F.slice("t", i + 2, F.coalesce(j - i, F.lit(0))), " "))
    near = F.transform(
        F.col("hits"),
        lambda h: (lambda i: F.struct(
            i.alias("place"),
            F.get("t", i).alias("token"),
            F.concat_ws(" ", F.when(i >= 2, F.get("t", i - 2)), F.when(i >= 1, F.get("t", i - 1))).alias("beside"),
            F.coalesce(F.get("t", i + 1), F.lit("")).alias("after"),
            F.when(F.col("assigns"), F.coalesce(_assigned_before(F.get("t", i), named(i), F.when(i >= 2, F.get("t", i - 2)).otherwise("")), F.lit(False)))
            .otherwise(False)
            .alias("marked"),
            (F.col("assigns") & F.coalesce(_user_option(F.get("t", i), named(i)), F.lit(False))).alias("optioned"),
            F.when(odd(F.get("t", i), '"'), upto(i, h["double"])).otherwise("").alias("double"),
            F.when(odd(F.get("t", i), "'"), upto(i, h["single"])).otherwise("").alias("single"),
        ))(h["i"]),
    )
    one = held.select("doc_id", "assigns", F.explode(near).alias("n")).select("doc_id", "assigns", "n.*")
    runs = F.when(run(F.col("token")), F.regexp_extract_all("token", F.lit(RUN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    # The closing quote in the tokens behind; without one the value ends with the token.
    open_quote = F.regexp_extract("token", rf"""(?i)(?:{_HEAD}|^[:=>]*+)(["'])(?!.*\2)""", 2)
    phrase = F.when(open_quote == '"', F.regexp_extract("double", r'^[^"]*+"', 0)).when(open_quote == "'", F.regexp_extract("single", r"^[^']*+'", 0)).otherwise("")
    whole = F.concat(F.when(F.col("marked"), F.lit(_MARK)).otherwise(""), "token", F.when(phrase != "", F.concat(F.lit(" "), phrase)).otherwise(""))
    values = F.when(F.col("assigns"), F.regexp_extract_all(whole, F.lit(_VALUE), F.lit(0))).otherwise(F.array().cast("array<string>"))
    one = one.withColumn("runs", runs).withColumn("values", values)
    bare = lambda x: F.regexp_replace(x, rf"""(?i)^{_HEAD}""", "")
    plain = lambda x: F.regexp_replace(bare(x), rf"""(?i)^["'`]?(?:(?:{SCHEMES})\s++)?|["'`]$""", "")
    head = lambda x: F.translate(F.substring(x, F.lit(1), F.length(x) - F.length(bare(x))), _MARK, "")
    parts = F.transform(
        "values",
        lambda x: F.struct(plain(x).alias("value"), F.concat(head(x), F.regexp_extract(bare(x), r"""^["'`]""", 0)).alias("before")),
    )
    keyed = lambda value: F.struct(value.alias("value"), F.substring("token", F.lit(1), F.instr("token", value) - 1).alias("before"))
    known = F.when(F.col("assigns"), F.regexp_extract_all("token", F.lit(_USER_INFO), F.lit(1))).otherwise(F.array().cast("array<string>"))
    known = F.concat(known, F.when(F.col("optioned"), F.array(F.regexp_extract("token", _USER_OPTION, 1))).otherwise(F.array().cast("array<string>")))
    parts = F.array_distinct(F.concat(parts, F.transform(known, keyed)))
    parts = F.filter(
        parts,
        lambda x: (x["value"] != "")
        & ~F.array_contains("runs", x["value"])
        & (F.regexp_replace(x["value"], _NAMED_RUN, "") != "")
        & ~x["value"].rlike(rf"(?i)^(?:{SCHEMES})$"),
    )
    own = F.transform(
        "runs", lambda x: F.struct(x.alias("value"), F.substring("token", F.lit(1), F.instr("token", x) - 1).alias("before"), F.lit(False).alias("assigned_whole"))
    )
    more = F.transform("parts", lambda x: F.struct(x["value"].alias("value"), x["before"].alias("before"), F.lit(True).alias("assigned_whole")))
    out = one.withColumn("parts", parts).select(
        "doc_id", "place", "token", "beside", "after", F.posexplode(F.concat(own, more)).alias("ord", "one")
    )
    return out.select("doc_id", "place", "token", "beside", "after", "ord", "one.value", "one.before", "one.assigned_whole")


def _assigned_before(token: Column, left: Column, left2: Column) -> Column:
    """Does the token hold a value whose key word, or key word and sign, are the tokens before it?"""
    key = rf"""(?i){KEY_WORDS[4:]}\w*+['"]?"""
    sign = left.rlike(r"^(?:[:=]+|is)$")
    scheme = left.rlike(f"(?i)^(?:{SCHEMES})$") & left2.rlike(key + r"[:=]+$")
    ends = left.rlike(key + r"[:=]+$") | sign & left2.rlike(key + "$") | scheme
    return ends & ~token.rlike(r"^[:=]+$") | token.rlike(r"^[:=]+[^:=]") & left.rlike(key + "$")


def _user_option(token: Column, left: Column) -> Column:
    return left.rlike("^(?:-u|--user|--proxy-user)$") & token.rlike(_USER_OPTION)


def _words(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Words that most of a bounded sample of the documents hold, and a few of placeholders; ``VOCABULARY`` at most."""
    key = F.col(id_col).cast("string")
    ids = docs.select(key.alias("_id")).filter("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
    texts = docs.select(key.alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "_id", "left_semi")
    held = texts.select(F.explode(F.filter(_letters(F.col("text")), lambda w: F.length(w).between(WORD, 14) & w.rlike("^[a-z]+$"))).alias("word"))
    rows = held.groupBy("word").count().orderBy(F.desc("count"), "word").limit(VOCABULARY).collect()
    return ["example", "sample", "change", "default", "value", "your", "here", "test", *[r["word"] for r in rows]]


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = PLANTS) -> DataFrame:
    """Labelled findings: those of ``lines`` made lines, with ``label`` 1 for a made secret and 0 for a look-alike.

    Secrets are random hex, base64 and mixed strings beside key words, in addresses and options, and credentials of
    published formats anywhere. Look-alikes are names, references, placeholders, words and paths, which stand beside the
    same key words as often as elsewhere, and digests, identifiers and letter runs elsewhere. Words are the documents'.
    """
    words = F.split(F.lit(" ".join(_words(docs, id_col, text_col))), " ")
    rnd = lambda k, n: F.pmod(F.xxhash64(F.lit(SEED), F.col("id"), F.lit(k)), F.lit(n)).cast("int")
    word = lambda k: F.get(words, F.pmod(F.xxhash64(F.lit(SEED), F.col("id"), F.lit(k)), F.size(words).cast("long")).cast("int"))
    hexed = lambda k: F.sha2(F.concat_ws(":", F.lit(str(SEED)), "id", F.lit(str(k))), 256)
    based = lambda k: F.translate(F.base64(F.unhex(hexed(k))), "=", "")
    alnum = lambda k: F.translate(based(k), "+/", "q7")
    cut = lambda x, low, high: F.substring(x, F.lit(1), low + rnd(f"cut{low}", high - low + 1))
    one_of = lambda k, options: F.get(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), rnd(k, len(options)))
    join = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    mixed = join(F.substring(alnum("m"), 1, 4), one_of("p1", "!#%&$"), cut(alnum("n"), 3, 8), one_of("p2", "!?*+."), rnd("m2", 90))
    made = one_of("made", [cut(hexed("h"), 18, 64), cut(based("b"), 16, 43), mixed])
    digits = F.translate(hexed("d"), "abcdef", "123456")
    # Published credential formats.
    published = one_of(
        "format",
        [
            join("AKIA", F.upper(F.substring(alnum("a"), 1, 16))),
            join("ghp_", F.substring(alnum("g"), 1, 36)),
            join("xoxb-", F.substring(digits, 1, 12), "-", F.substring(alnum("x"), 1, 24)),
            join("sk_live_", F.substring(alnum("k"), 1, 24)),
            join("glpat-", F.substring(alnum("l"), 1, 20)),
        ],
    )
    named = one_of(
        "named",
        [
            join(word(1), "-", word(2), "-", word(3)),
            join(word(1), "_", word(2), "_", rnd("no", 100)),
            join(F.initcap(word(1)), F.initcap(word(2)), F.initcap(word(3))),
            join("${", F.upper(word(1)), "_", F.upper(word(2)), "}"),
            join("your_", word(1), "_here"),
            F.repeat(one_of("fill", ["x", "*", "X", "0"]), 8 + rnd("fills", 17)),
            join("/", word(1), "/", word(2), "/", word(3)),
            join("get_", word(1), "(", word(2), ")"),
            join(word(1), word(2), word(3), word(4)),
            word(1),
        ],
    )
    other = one_of(
        "other",
        [
            F.substring(hexed("o"), F.lit(1), one_of("size", [32, 40, 64])),
            join(*[x for i, n in enumerate((8, 4, 4, 4, 12)) for x in (F.substring(hexed("u"), 1 + 12 * i, n), "-")][:-1]),
            F.substring(digits, 1, 16),
            cut(F.translate(hexed("t"), "0123456789", "aeiourstln"), 16, 30),
        ],
    )
    key = one_of("key", ["password", "passwd", "db_password", "secret", "client_secret", "token", "auth_token", "api_key", "apikey", "access-key", "credential"])
    v = F.col("made_value")
    beside_key = one_of(
        "keyed",
        [
            join(key, "=", v),
            join(key, ": ", v),
            join(key, ' = "', v, '"'),
            join(key, "='", v, "'"),
            join('"', key, '": "', v, '",'),
            join("export ", F.upper(F.translate(key, "-", "_")), "=", v),
            join(key, " is ", v),
            join(one_of("at", ["postgres", "https", "amqp"]), "://", word(7), ":", v, "@", word(8), ".example/", word(9)),
            join("curl -u ", word(7), ":", v),
            join("Authorization: ", one_of("as", ["Basic", "Bearer"]), " ", v),
        ],
    )
    elsewhere = one_of(
        "free",
        [v, v, join("commit ", v), join("sha256: ", v), join("id=", v), join("order ", v), join("https://", word(7), ".example/", word(8), "/", v), join('name="', v, '"')],
    )
    half = rnd("half", 2) == 0
    kinds = docs.sparkSession.range(0, lines, 1, 8).select(
        "id",
        (F.col("id") % 2).cast("int").alias("secret"),
        F.when(F.col("id") % 2 == 1, F.when(half, made).otherwise(published)).otherwise(F.when(rnd("look", 3) > 0, named).otherwise(other)).alias("made_value"),
        F.when(F.col("id") % 2 == 1, half | (rnd("spot", 2) == 0)).otherwise((rnd("look", 3) > 0) & (rnd("spot", 2) == 0)).alias("keyed"),
    )
    text = F.concat_ws(" ", word(11), word(12), F.when(F.col("keyed"), beside_key).otherwise(elsewhere), word(13))
    made_lines = stored(kinds.withColumn("text", text))
    found = findings(made_lines, "id").withColumnRenamed("doc_id", "id")
    marked = found.join(made_lines.select("id", "secret", "made_value"), "id")
    kept = marked.filter((F.col("secret") == 0) | (F.col("value") == F.col("made_value")))
    no_id = F.lit(None).cast(docs.schema[id_col].dataType)
    return kept.withColumn("doc_id", no_id).withColumn("label", F.col("secret")).drop("id", "secret", "made_value")


def _letters(text: Column) -> Column:
    """Distinct words of a text: what stands between ASCII characters that are no letters, in lower case."""
    other = "".join(chr(c) for c in range(128) if not chr(c).isalpha())
    return F.array_distinct(F.split(F.translate(F.coalesce(text, F.lit("")), other + UPPER, " " * len(other) + LOWER), " "))


def _runs_of(classes: Column) -> Column:
    return F.length(F.regexp_replace(classes, r"(.)\1*+", "x"))


def _dictionary(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(word): letter runs of the findings that ``MIN_DOCS`` documents hold as a word of their own."""
    asked = stored(found.select(F.explode(F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{WORD},}}"), F.lit(0))).alias("word")).distinct())
    own = F.filter(_letters(F.col(text_col)), lambda w: F.length(w) >= WORD)
    words = docs.select(F.explode(own).alias("word")).join(small(asked, text="word"), "word", "left_semi")
    return words.groupBy("word").count().filter(F.col("count") >= MIN_DOCS).select("word")


def features(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``found`` with the columns of FEATURES."""
    values = found.select("value").distinct()
    parts = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{WORD},}}"), F.lit(0))).alias("word"))
    covered = parts.join(small(stored(_dictionary(docs, found, text_col)), text="word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    v, n = F.col("value"), F.length("value")
    kinds = F.translate(v, LOWER + UPPER + "0123456789+/_-=", "l" * 26 + "u" * 26 + "d" * 10 + "s" * 5)
    vowels = F.translate(F.lower(v), "aeiouybcdfghjklmnpqrstvwxz0123456789+/_-=", "v" * 6 + "c" * 20 + "d" * 10 + "s" * 5)
    both = F.concat_ws(" ", "beside", "before")
    share = lambda chars: (n - F.length(F.translate(v, chars, ""))) / n
    return found.join(small(stored(covered), text="value"), "value", "left").withColumns(
        {
            "length": n.cast("double"),
            "class_runs": _runs_of(kinds) / n,
            "vowel_runs": _runs_of(vowels) / n,
            "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
            "digits": share("0123456789"),
            "uppers": share(UPPER),
            "coverage": F.coalesce(F.col("covered"), F.lit(0)) / n,
            "slashes": share("/"),
            "dots": F.col("before").contains(".").cast("double"),
            "in_url": F.col("token").contains("://").cast("double"),
            "in_address": F.col("token").contains("@").cast("double"),
            "key_beside": both.rlike(KEY_WORDS + _ASKS).cast("double"),
            "other_beside": F.concat_ws(" ", both, "after").rlike(OTHER_WORDS).cast("double"),
            "assigned": both.rlike(rf"""(?i)(?:[:=]|\sis|{SCHEMES})\s*['"]?$""").cast("double"),
            "quoted": F.col("before").rlike(r"""['"`]$""").cast("double"),
        }
    ).drop("covered")


def fit(judged: DataFrame, per_class: int = PER_CLASS):
    """A random forest on a bounded sample of the findings with features and ``label``; None without both classes.

    The sample takes distinct rows (a value with the same words and features counts once, however often it is copied) by a
    hash of value and context, ``per_class`` of either class at most.
    """
    cols = ["label", *FEATURES]
    context = ["value", "beside", "after", "before"]
    order = [F.xxhash64(*context), *context, *FEATURES]
    judged = judged.select(*cols, *context).distinct()
    sample = None
    for c in (0, 1):
        own = judged.filter(F.col("label") == c).orderBy(*order).limit(per_class).select(*cols)
        sample = own if sample is None else sample.unionByName(own)
    sample = stored(sample.repartition(4))
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(size) < 2:
        return None
    total = sum(size.values())
    weight = F.when(F.col("label") == 1, total / (2.0 * size[1])).otherwise(total / (2.0 * size[0]))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", weightCol="w", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", cacheNodeIds=False
    )
    # Kept as files: the loaded model has no training summary, which would tie every task to this session.
    path = f"{scratch(judged.sparkSession)}/forest-{uuid.uuid4().hex}"
    forest.fit(_vectors(sample.withColumn("w", weight))).save(path)
    return RandomForestClassificationModel.load(path)


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(df)


def judge(judged: DataFrame, model) -> DataFrame:
    """Findings with ``probability`` of being a secret; without a model every finding may be one."""
    if model is None:
        return judged.withColumn("probability", F.lit(1.0))
    return model.transform(_vectors(judged)).withColumn("probability", F.round(vector_to_array("probability")[1], 6))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP, labelled: DataFrame | None = None) -> DataFrame:
    """One row per finding: where it is, the digest of its value (never the value), its probability and the verdict.

    ``labelled`` has the columns of :func:`findings` and ``label`` (1 secret, 0 none); without it findings are planted.
    Repeated rows of ``docs`` repeat their findings; texts without findings, empty and null ones give no rows.
    """
    taught = planted(docs, id_col, text_col) if labelled is None else labelled.filter("label is not null")
    found = findings(docs, id_col, text_col).withColumn("label", F.lit(None).cast("int"))
    judged = stored(features(docs, stored(found.unionByName(taught.select(*found.columns))), text_col))
    return judge(judged.filter("label is null"), fit(judged.filter("label is not null"))).select(
        "doc_id",
        F.col("place").cast("long").alias("token_no"),
        F.col("ord").cast("long").alias("run_no"),
        F.length("value").cast("long").alias("n_chars"),
        F.sha2("value", 256).alias("value_sha256"),
        "probability",
        (F.col("probability") >= keep).alias("is_secret"),
    )
