"""Secret scan: candidates, features and a random forest, in DataFrame functions throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: The forest is trained on so many planted findings, and on about so many natural look-alikes, chosen by a hash from all of them.
PLANTED, SAMPLE_FINDINGS = 6000, 20_000
TREES, DEPTH = 24, 7
KEEP = 0.5
#: Characters kept on either side of a candidate, for neighbouring words.
NEAR = 40

#: A run of at least ten token characters with a digit among them, matched whole.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]*[A-Za-z0-9+/_-]{10,}+=*+"
#: A private key in its armour, over any number of lines; headers within may hold a few single signs.
ARMOUR = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[^-]*+(?:-{1,4}+[^-]++){0,20}-----END [A-Z ]{0,40}PRIVATE KEY-----"
#: A name that ends in a word for a password, and the sign that assigns it.
NAMED = r"(?i:[a-z_-]{0,30}(?:password|passwd|passphrase|pwd|secret))[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
#: What such a name announces: 6 to 256 characters with a letter or digit, and with a sign that tokens lack.
#: A name is looked at closely only if a sign of assignment follows its at most 40 characters.
PASSWORD = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z_-]{3,40}+[\"']?[ \t]{0,3}[=:])" + NAMED + r"(?=[^\s\"'<>]{0,255}[!@#$%^&*?~{}])(?=[^\s\"'<>]{0,255}[A-Za-z0-9])[^\s\"'<>]{5,255}[^\s\"'<>.,;:)]"
CANDIDATE = f"{ARMOUR}|{PASSWORD}|{TOKEN}"
#: A candidate's leading name and sign of assignment, which count as neighbours.
ASSIGNED = rf"^(?:{NAMED}|[A-Za-z_][A-Za-z_-]{{1,30}}=)"

# Public formats of keys.
FORMATS = {
    "cloud_key": r"^(?:AKIA|ASIA)[A-Z0-9]{16}$",
    "forge_token": r"^gh[pousr]_[A-Za-z0-9]{36}$",
    "payment_key": r"^[sr]k_(?:live|test)_[A-Za-z0-9]{16,}$",
    "chat_token": r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    "web_token": r"^eyJ[A-Za-z0-9_-]{10,}$",
    "private_key": r"^-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
# Words that announce a secret, words that deny one, and a small dictionary.
SECRET_CUES = "password|passwd|passphrase|pwd|token|secret|apikey|api_key|api-key|access_key|private|credential|bearer|auth"
DENYING_CUES = "example|sample|dummy|test|placeholder|version|revision|commit|checksum|uuid|isbn|phone|order|invoice"
DICTIONARY = "the|and|ing|tion|ment|er|an|in|on|at|en|es|de|la|le|user|name|data|file|page|test|pass|word|item|code|http|www|com"


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, value, start, end, before, after) of every candidate in every whole text; code points, ends exclusive."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), text.alias("body"))
    found = rows.withColumn("found", F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0))).filter(F.size("found") > 0).withColumn("row", F.monotonically_increasing_id())
    gaps = F.split("body", CANDIDATE, -1)
    side = lambda take: F.transform(gaps, lambda g: take(g, F.lit(NEAR)))
    before, after = F.slice(side(F.right), 1, F.size("found")), F.slice(side(F.left), 2, F.size("found"))
    parts = F.arrays_zip(F.col("found").alias("whole"), F.transform(gaps, F.length).alias("gap"), before.alias("tail"), after.alias("head"))
    each = found.select("doc_id", "path", "row", F.posexplode(parts).alias("i", "c")).select("doc_id", "path", "row", "i", "c.*").filter("whole is not null")
    # A candidate starts after all gaps up to its own and all candidates before it.
    until = F.sum((F.col("gap") + F.length("whole")).cast("long")).over(Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("at", until - F.length("whole"))
    name = F.regexp_extract("whole", ASSIGNED, 0)
    each = each.withColumn("name", name).withColumn("value", F.expr("substring(whole, length(name) + 1)"))
    start = F.col("at") + F.length("name")
    return each.select("doc_id", "path", "value", start.alias("start"), (start + F.length("value")).alias("end"), F.concat("tail", "name").alias("before"), F.col("head").alias("after"))


def _share(value: Column, pattern: str) -> Column:
    """The part of the value's characters that matches of the pattern cover."""
    return 1 - F.length(F.regexp_replace(value, pattern, "")) / F.greatest(F.length(value), F.lit(1))


def _times(value: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(value, F.lit(pattern), F.lit(0))).cast("double")


FEATURES = ["length", "digits", "uppers", "hexes", "turns", "case_turns", "distinct", "covered", "cue", "denied", "assigned", "quoted", "signs", "template", "path_denied", "path_config"]


def with_features(found: DataFrame) -> DataFrame:
    """Length, character transitions, dictionary coverage, path and neighbouring words of each candidate."""
    v, before, n = F.col("value"), F.lower("before"), F.greatest(F.length("value"), F.lit(1))
    word = F.regexp_extract(before, r"([a-z_-]+)[^a-z]*$", 1)
    made = {
        "length": F.least(F.length(v), F.lit(200)).cast("double"),
        "digits": _share(v, "[0-9]"),
        "uppers": _share(v, "[A-Z]"),
        "hexes": _share(v, "[0-9a-f]"),
        "turns": _times(v, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])") / n,
        "case_turns": _times(v, "[a-z](?=[A-Z])|[A-Z](?=[a-z])") / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(40)),
        "covered": _share(F.lower(v), DICTIONARY),
        "cue": word.rlike(SECRET_CUES).cast("double"),
        "denied": (before.rlike(DENYING_CUES) | F.lower("after").rlike(DENYING_CUES)).cast("double"),
        "assigned": before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": (before.rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "signs": _share(v, "[^A-Za-z0-9]"),
        "template": v.rlike(r"^[$%#@]?[({][^)}]*[)}]+$|^[$%][A-Za-z_]+%?$|\*{3}").cast("double"),
        "path_denied": F.lower("path").rlike("test|example|sample|fixture|doc").cast("double"),
        "path_config": F.lower("path").rlike("conf|env|settings|secret|deploy").cast("double"),
    }
    return found.withColumns({k: F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in made.items()})


# What stands before and after a planted secret, and before a planted look-alike.
ANNOUNCED = (("token = \"", "\""), ("password: ", " "), ("api_key=", " "), ("secret = '", "'"), ("Authorization: Bearer ", " "), ("access_key = \"", "\""), ("client_secret: \"", "\","))
MENTIONED = (("commit ", " "), ("checksum ", "."), ("order number ", " "), ("version ", " "), ("see ", ","), ("isbn ", " "), ("id: ", " "), ("uuid = \"", "\""), ("(", ")"), ("", " "))
PASSWORDS = (("password: ", " "), ("password=\"", "\""), ("db_password = '", "'"), ("pwd=", ";"), ("passwd: ", ","), ("client_secret=", " "))
TEMPLATES = ("${DB_PASSWORD}", "{{ password }}", "{{password}}", "%PASSWORD%", "$PASSWORD", "{password}", "********", "your-password!", "${env.SECRET}", "%(password)s", "{user.name}", "#{secret}")
PATHS = ("web", "books", "news", "code/app.py", "conf/settings.env", "tests/fixture.txt", "docs/readme.md")
#: Natural look-alikes: numbers, dates and versions, identifiers in the common layout, and text that words cover. The value alone decides.
LOOK_ALIKES = r"^[0-9_/+-]+$|^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[vV]?[0-9]+(?:[-_][0-9]+)*[A-Za-z]{0,3}$"


def planted(spark: SparkSession, n: int = PLANTED, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """n labelled findings made by rule: secrets of each format and without one, in announcing context or none, and look-alikes where such stand.

    Random-looking values without a format are secrets only where they are announced: the same forty hexadecimal digits are a token or a commit. leave_out: formats to do without.
    """
    rows = spark.range(n).withColumn("hex", F.concat(F.sha2(F.concat(F.lit("a"), "id"), 256), F.sha2(F.concat(F.lit("b"), "id"), 256)))
    mixed, digits = F.regexp_replace(F.base64(F.unhex("hex")), "[^A-Za-z0-9]", "7"), F.regexp_replace("hex", "[^0-9]", "")
    size = lambda low, high: F.lit(low) + F.pmod(F.xxhash64("id", F.lit(low), F.lit(high)), F.lit(high - low + 1)).cast("int")
    part = lambda c, low, high: F.substring(c, F.lit(1), size(low, high))
    formats = {
        "cloud_key": F.concat(F.lit("AKIA"), F.substring(F.upper(mixed), 1, 16)), "forge_token": F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), "payment_key": F.concat(F.lit("sk_live_"), part(mixed, 16, 32)),
        "chat_token": F.concat(F.lit("xoxb-"), F.substring(digits, 1, 12), F.lit("-"), F.substring(mixed, 1, 24)), "web_token": F.concat(F.lit("eyJ"), part(mixed, 30, 80)),
        "private_key": F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), F.substring(mixed, 1, 64), F.lit("\n"), F.substring(F.reverse(mixed), 1, 20), F.lit("==\n-----END RSA PRIVATE KEY-----")),
    }
    uuid = F.concat_ws("-", *(F.substring("hex", at, k) for at, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    words = F.concat(F.lit("data"), F.substring(digits, 1, 2), F.lit("the"), F.substring(digits, 3, 1), F.lit("user"), F.substring("hex", 1, 2), F.lit("ing"))
    free = [F.substring("hex", 1, 40), F.substring("hex", 1, 32), part(mixed, 16, 48), part("hex", 20, 64)]
    lookalike = [F.substring("hex", 1, 40), F.substring("hex", 1, 64), uuid, part(digits, 10, 24), F.concat(F.lit("ORD-2024-"), F.substring(digits, 1, 8)), words, part(mixed, 12, 30)]
    made = [(k, v, 1.0) for k, v in formats.items() if k not in leave_out] + [("free", v, 1.0) for v in free] + [("other", v, 0.0) for v in lookalike]
    sign = lambda seed: F.substring(F.lit("!@#$%^&*?~"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10)).cast("int") + 1, F.lit(1))
    template = F.element_at(F.array(*map(F.lit, TEMPLATES)), (F.pmod(F.xxhash64("id", F.lit(23)), F.lit(len(TEMPLATES))) + 1).cast("int"))
    made += [("pass", F.concat(part(mixed, 4, 9), sign(29), F.substring(digits, 1, 2)), 1.0), ("pass", F.concat(F.substring(words, 1, 8), sign(31), sign(37)), 1.0), ("pass", template, 0.0)]
    spot = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(len(made))).cast("int")
    rows = rows.withColumn("made", F.element_at(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value"), F.lit(y).alias("label")) for k, v, y in made)), spot + 1)).select("id", "made.*")
    pick = lambda some, seed: F.element_at(F.array(*(F.struct(F.lit(x).alias("b"), F.lit(y).alias("a")) for x, y in some)), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(some))) + 1).cast("int"))
    bare = (F.col("kind") != "free") & (F.col("kind") != "pass") & (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) == 0)
    near = F.when(F.col("kind") == "pass", pick(PASSWORDS, 19)).when((F.col("label") == 1) & ~bare, pick(ANNOUNCED, 11)).otherwise(pick(MENTIONED, 13))
    path = F.element_at(F.array(*map(F.lit, PATHS)), (F.pmod(F.xxhash64("id", F.lit(17)), F.lit(len(PATHS))) + 1).cast("int"))
    return rows.withColumn("near", near).select(F.lit(-1).cast("long").alias("doc_id"), path.alias("path"), "value", F.col("id").alias("start"), F.col("id").alias("end"), F.concat(F.lit("some words and "), "near.b").alias("before"), F.concat("near.a", F.lit(" then more")).alias("after"), "label")


def with_kind(found: DataFrame) -> DataFrame:
    """Adds kind: the public format of the value, or whether a word announces it."""
    kind = reduce(lambda rest, k: F.when(F.col("value").rlike(FORMATS[k]), F.lit(k)).otherwise(rest), reversed(FORMATS), F.when(F.col("cue") == 1, F.lit("announced")).otherwise(F.lit("other")))
    return found.withColumn("kind", kind)


def train(found: DataFrame, most: int = SAMPLE_FINDINGS, leave_out: tuple[str, ...] = ()):
    """A random forest on planted findings and on natural look-alikes among `found`, as many of these as a sample of `most` findings holds."""
    spot = F.pmod(F.xxhash64("doc_id", "start", F.lit(7)), F.lit(1 << 31))
    alike = found.filter(F.col("value").rlike(LOOK_ALIKES) & ~F.col("kind").isin(*FORMATS))
    n = alike.count()
    natural = alike.filter(spot < min(1 << 31, int((1 << 31) * most / max(n, 1)) + 1)).withColumn("label", F.lit(0.0))
    some = with_features(planted(found.sparkSession, leave_out=leave_out)).select("label", *FEATURES).unionByName(natural.select("label", *FEATURES))
    some = staged(some.repartition(1).sortWithinPartitions("label", *FEATURES), "findings")
    return RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=11, subsamplingRate=0.8).fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(some))


def scored(found: DataFrame, model) -> DataFrame:
    """found with chance, the forest's probability that a finding is a secret."""
    return model.transform(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found)).withColumn("chance", vector_to_array("probability")[1])


def scan(docs: DataFrame, most: int = SAMPLE_FINDINGS, keep: float = KEEP, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, start, end, kind, value, probability) of the findings that the forest keeps.

    Every whole text is searched. Findings are staged once; the forest is trained on planted findings and a bounded sample of natural look-alikes, and applied to all.
    Null texts and paths are empty. Repeated rows give their findings again; an empty table gives none. leave_out: formats without planted findings, to measure what the
    forest finds without having seen them.
    """
    found = staged(with_kind(with_features(candidates(docs))), "candidates")
    return scored(found, train(found, most, leave_out)).filter(F.col("chance") >= keep).select("doc_id", "start", "end", "kind", "value", F.round("chance", 6).alias("probability"))


def query(spark, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "kind", "probability", F.sha2("value", 256).alias("value_sha256"))
