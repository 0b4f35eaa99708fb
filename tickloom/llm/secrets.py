"""Secret scan: candidates by pattern, false positives removed by a random forest.  DataFrame functions only.

Candidates are runs of key characters that hold a digit or follow a word for a secret, private key headers and passwords
after a keyword (in any case; quotes, an equals sign or colon and up to four blanks a side may lie between).  Each is
described by its length, its character classes and the transitions between them, the share of it that dictionary words
cover, the path it was found under, and the words next to it.  Spark ML's random forest (JVM) is trained on labelled
findings: those given, or ``labelled_findings``, a bounded table made from a rule.  A candidate stays a finding where the
forest gives at least one half.

Defined results: a null or empty text has no candidates; a null path counts as empty; a null identifier is reported as
null; rows that share an identifier are scanned on their own; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled findings that the forest is trained on at most.
FINDINGS = 6_000
TREES, DEPTH, SEED = 40, 7, 11
_SECRET_WORDS = "token|secret|passwd|password|pwd|api|apikey|key|auth|bearer|credential|private|access"
PATTERN = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"|(?<=[\s\"'=:])(?<![^\s=:]\s)(?=[^\s\"']{6})(?<=[=:]\s{0,4}[\"']{0,1})(?<=(?i:password|passwd|pwd)[\"']{0,1}\s{0,4}[=:]\s{0,4}[\"']{0,1})[^\s\"']{6,}"
    r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
    rf"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{{16}})(?<=(?i:{_SECRET_WORDS})[\"']{{0,1}}\s{{0,4}}[=:]{{0,1}}\s{{0,4}}[\"']{{0,1}})[A-Za-z+/_-]{{16,}}={{0,2}}"
)
#: What each candidate holds at least.
POSSIBLE = r"[A-Za-z0-9+/_-]{16}|(?i:passw|pwd)|PRIVATE KEY"
#: Candidates of a text whose starts are summed at once.
CHUNK = 256
_OTHER_WORDS = "commit|sha|sha1|sha256|md5|hash|checksum|digest|uuid|guid|etag|revision|rev|version|build|integrity|blob|tree|id|serial|isbn|order|invoice|card"
_DICTIONARY = "example|sample|test|dummy|fake|changeme|placeholder|your|here|insert|foo|bar|abc|xyz|123|token|secret|password|key|value|name|path|file|index|page|user|data|image|version|release|module|class|function|config|the|and|tion|ing|ment"
_TESTING = "test|spec|fixture|example|sample|doc|mock|demo"
_SHIFTS = r"(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
NAMES = ["length", "digits", "upper", "lower", "hex", "variety", "shifts", "repeats", "covered", "vowels", "path_test", "path_depth", "near_secret", "near_other", "assigned", "quoted", "next_secret", "next_other"]


def _made(df: DataFrame) -> DataFrame:
    """``df`` as it is, its columns made once: what reads them in a lambda doesn't make them anew for each element."""
    return df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("made")).select("made.*")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Rows (doc, path, k, start, found, before, after) of the candidates, start in characters from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    # Texts without a run of key characters, a word for a password or a key header have no candidate; the long pattern isn't tried on them.
    parts = docs.select(F.col(id_col).alias("doc"), path.alias("path"), text.alias("text")).where(F.col("text").rlike(POSSIBLE))
    parts = parts.select("doc", "path", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("all"), F.split("text", PATTERN, -1).alias("gaps"))  # gap k lies before candidate k
    # Steps from one candidate's start to the next, their sums by chunk, and sums of chunks before a chunk: each start then takes one chunk at most.
    n, chunk = F.size("all"), F.lit(CHUNK)
    step = lambda k: F.length(F.get("gaps", k)) + F.when(k > 0, F.length(F.get("all", k - 1))).otherwise(0)
    sums = lambda steps: F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    parts = _made(parts)
    parts = _made(parts.withColumn("steps", F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), step)).otherwise(F.array().cast("array<int>"))))
    parts = _made(parts.withColumn("chunks", F.transform(F.sequence(F.lit(0), F.floor(F.size("steps") / chunk).cast("int")), lambda c: sums(F.slice("steps", c * chunk + 1, chunk)))))
    parts = _made(parts.withColumn("sums", F.transform(F.sequence(F.lit(0), F.size("chunks") - 1), lambda c: sums(F.slice("chunks", F.lit(1), c)))))

    def one(k: Column) -> Column:
        c = F.floor(k / chunk).cast("int")
        start = F.get("sums", c) + sums(F.slice("steps", c * chunk + 1, k - c * chunk + 1))
        return F.struct(k.alias("k"), start.alias("start"), F.get("all", k).alias("found"), F.right(F.get("gaps", k), F.lit(60)).alias("before"), F.left(F.get("gaps", k + 1), F.lit(40)).alias("after"))

    # One small struct for each candidate before rows are made, so that no row holds the arrays of its text.
    each = F.when(F.size("steps") > 0, F.transform(F.sequence(F.lit(0), F.size("steps") - 1), one))
    return parts.select("doc", "path", each.alias("each")).select("doc", "path", F.inline("each"))


def _share(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(kind)) / F.greatest(F.length(text), F.lit(1))


def features(found: DataFrame) -> DataFrame:
    """``found`` with a column for each of ``NAMES``."""
    c, low = F.col("found"), F.lower("found")
    n = F.greatest(F.length(c), F.lit(1))
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    near = F.lower("before")
    last = F.regexp_extract(near, r"([a-z0-9_.-]+)[^a-z0-9]{0,6}$", 1)
    follow = F.regexp_extract(F.lower("after"), r"^[^a-z0-9]{0,6}([a-z0-9_.-]+)", 1)
    values = {
        "length": F.least(F.length(c), F.lit(200)), "digits": _share(c, "[0-9]"), "upper": _share(c, "[A-Z]"), "lower": _share(c, "[a-z]"),
        "hex": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("int"), "variety": F.size(F.array_distinct(chars)) / F.sqrt(n.cast("double")),
        "shifts": F.regexp_count(c, F.lit(_SHIFTS)) / n, "repeats": _share(c, r"(.)(?=\1)"),
        "covered": 1 - F.length(F.regexp_replace(low, f"(?:{_DICTIONARY})", "")) / n, "vowels": _share(low, "[aeiou]"),
        "path_test": F.lower("path").rlike(_TESTING).cast("int"), "path_depth": F.regexp_count(F.col("path"), F.lit("/")),
        "near_secret": last.rlike(f"(?:{_SECRET_WORDS})$").cast("int"), "near_other": last.rlike(f"^(?:{_OTHER_WORDS})$").cast("int"),
        "assigned": near.rlike(r"[=:]\s{0,2}[\"']?$").cast("int"), "quoted": near.rlike(r"[\"']$").cast("int"),
        "next_secret": follow.rlike(f"^(?:{_SECRET_WORDS})").cast("int"), "next_other": (near.rlike(f"(?:^|[^a-z])(?:{_OTHER_WORDS})[^a-z]") | follow.rlike(f"^(?:{_OTHER_WORDS})$")).cast("int"),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()})


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """Labelled findings by rule: random keys next to words for secrets against hashes, identifiers, placeholders and words."""
    i = F.col("id")
    pick = lambda salt, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(xs))).cast("int") + 1)
    hexes = F.sha2(i.cast("string"), 512)
    base = F.regexp_replace(F.base64(F.unhex(hexes)), "[=]", "")
    digits = F.regexp_replace(F.translate(hexes, "abcdef", ""), "[^0-9]", "")
    word = lambda s: pick(s, "value", "module", "release", "handler", "controller", "service", "image", "report", "document", "network", "section", "element")
    flip = lambda salt, p: F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(100)) < p
    secret = pick(1, "token", "secret", "api_key", "password", "auth_token", "access_key", "client_secret", "private_key", "bearer", "key")
    other = pick(2, "commit", "sha256", "md5", "checksum", "uuid", "etag", "revision", "build", "hash", "digest", "blob", "id")
    length = F.element_at(F.array(*[F.lit(x) for x in (20, 24, 32, 40, 40, 48, 64)]), F.pmod(F.xxhash64(i, F.lit(3)), F.lit(7)).cast("int") + 1)
    join = pick(4, " = \"", "=", ": ", " = '", ":\"")
    kind = F.pmod(i, F.lit(12))
    cases = [  # label, candidate, text before
        (1, F.substring(hexes, 1, 40), F.concat(word(5), F.lit(" "), secret, join)),
        (1, F.left(base, length), F.concat(word(5), F.lit(" "), secret, join)),
        (1, F.concat(F.lit("AKIA"), F.upper(F.left(F.translate(base, "+/", "A7"), F.lit(16)))), F.concat(F.lit("aws_access_key_id"), join)),
        (1, F.concat(pick(6, "ghp_", "sk_live_", "xoxb-", "glpat-"), F.left(F.translate(base, "+/", "b8"), F.lit(36))), F.when(flip(7, 70), F.concat(secret, join)).otherwise(F.concat(word(8), F.lit(" ")))),
        (1, F.left(hexes, length), F.concat(secret, join)),
        (0, F.left(hexes, length), F.concat(word(5), F.lit(" "), other, pick(9, " ", ": ", " = \"", ":", "="))),
        (0, F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12)), F.when(flip(7, 60), F.concat(other, join)).otherwise(F.concat(word(8), F.lit(" ")))),
        (0, F.concat(pick(10, "your_", "example-", "test_", "xxxx", "dummy_", "sample-"), pick(11, "token_here_", "api_key_", "secret_value_", "password_"), pick(12, "123", "1234567890", "000000", "1")), F.concat(secret, join)),
        (0, F.left(digits, F.lit(16)), F.concat(word(5), F.lit(" "), word(8), F.lit(" "))),
        (0, F.concat(word(13), pick(14, "_", "-", "/"), word(15), pick(14, "_", "-", "/"), word(16), F.substring(digits, 1, 2)), F.concat(word(5), pick(17, " ", " = \"", ": "))),
        (0, F.repeat(pick(18, "0", "x1", "ab1", "12", "a1"), 12), F.concat(secret, join)),
        (0, F.left(hexes, length), F.concat(word(5), F.lit(" "), word(8), F.lit(" "))),
    ]
    choose = lambda k: F.coalesce(*[F.when(kind == n, F.lit(c[k]) if k == 0 else c[k]) for n, c in enumerate(cases)])
    out = spark.range(0, min(rows, FINDINGS), 1, 4).select(
        "id", choose(0).alias("label"), choose(1).alias("found"), choose(2).alias("before"), F.when(F.col("id") % 2 == 0, F.lit("\" ")).otherwise(F.lit(" ")).alias("quote"), word(19).alias("next"),
        pick(20, "src/app.py", "src1", "", "config/settings.yml", "tests/test_app.py", "docs/readme.md", "src7", "deploy/env").alias("path"),
    )
    return out.select("label", "found", "before", F.concat("quote", "next").alias("after"), "path").where(F.length("found") > 5)


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """The forest from rows (label, found, before, after, path), of which ``FINDINGS`` are taken at most."""
    rows = features(findings.limit(FINDINGS))
    table = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows).select("features", F.col("label").cast("double").alias("label"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", subsamplingRate=0.8).fit(table)


def scan(docs: DataFrame, model: RandomForestClassificationModel, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Candidates with the forest's probability of a secret (``p``)."""
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(features(candidates(docs, id_col, text_col, path_col)))
    return model.transform(rows).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))


def query(docs: DataFrame) -> DataFrame:
    """All candidates: doc_id, place, digest of the candidate, probability, and whether it stays a finding."""
    d = scan(docs, train(labelled_findings(docs.sparkSession)))
    return d.select(F.col("doc").alias("doc_id"), F.col("k").cast("long").alias("finding"), F.col("start").cast("long").alias("start"), F.length("found").cast("long").alias("length"), F.sha2(F.col("found").cast("binary"), 256).alias("found_sha256"), F.round("p", 6).alias("p"), (F.col("p") >= 0.5).alias("is_secret"))
