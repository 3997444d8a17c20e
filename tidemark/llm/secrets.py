"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame operations only.

A text is cut at its candidates: long runs of key characters, and values that
follow an assignment sign. What is cut out are the candidates, and what is left on
both sides is their neighbourhood, so positions and neighbours need no second look.

Features of a candidate: its length; transitions between neighbouring characters
(changes of class, of vowel and consonant, entropy, distinct characters, and how
improbable its pairs of letters are in the words of the corpus); how much of it the
words of the corpus cover; words of the document's path; and the neighbouring words.
The forest learns from labelled findings. Without a table of findings it learns from
three kinds of examples:

* findings that can be labelled by themselves: keys of a known format and values
  assigned to a name such as "password" are secrets; runs of digits, UUIDs, paths,
  dates, joined words and values that many texts repeat are not;
* the secrets among them once more as bare values, with the assignment cut out of
  the neighbourhood, so that the value has to decide and not the rule that labelled it;
* BUILT examples of kinds that a corpus may lack, made of its own words and of hash
  values: identifiers, paths, dates, checksums and placeholders against keys, bare,
  assigned and quoted.
"""

from __future__ import annotations

import json
from math import log2

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents, let
from tidemark.llm.registry import query

RUN = r"A-Za-z0-9_+/\-"
CANDIDATE = (rf"(?<![{RUN}])(?:(?=[A-Za-z_+/\-]{{0,63}}[0-9])[{RUN}]{{16,}}={{0,2}}|[{RUN}]{{20,}}={{0,2}})"
             rf"|(?<=[=:]\s?[\"']?)(?<![{RUN}])[{RUN}!@#$%^&*.]{{8,}}")
#: Formats of keys that name themselves (fixed values).
KNOWN = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9\-]{10,}$|^AIza[0-9A-Za-z_\-]{35}$"
         r"|^sk_live_[0-9a-zA-Z]{16,}$|^eyJ[A-Za-z0-9_\-]{16,}$")
NAMES = "passw|passwd|pwd|secret|token|api.?key|access.?key|auth|credential|private"
ASSIGNED = rf"(?i)({NAMES})[a-z_]{{0,12}}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?$"
HARMLESS = r"(?i)example|sample|dummy|placeholder|changeme|lorem|test"
NEAR = 40  # characters of neighbourhood on each side
#: Shapes of values that are no secrets of themselves (fixed values).
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
DATE = r"(?<![0-9])(19|20)[0-9]{2}([-/]?)(0[1-9]|1[0-2])\2([0-2][0-9]|3[01])(?![0-9])"
DIGEST = r"(?i)sha-?(1|256|512)|md5|checksum|digest|commit|revision|etag|hash"
MAX_FINDINGS, TREES, DEPTH, SEED = 20_000, 30, 8, 42
#: A word of the dictionary occurs this often; a value in this many different texts, assigned to no name, is no secret.
WORD_COUNT, REPEATED = 3, 5
#: Built examples, and most frequent words that they are made of; bounds of the training only.
BUILT, VOCABULARY = 4_000, 2_000
REDACTED = "[SECRET]"
FEATURES = ("size", "class_changes", "vowel_changes", "entropy", "distinct", "improbable", "digits", "capitals", "hexadecimal",
            "separators", "longest", "dated", "covered", "path_harmless", "path_config", "assigned", "sign_before", "quoted",
            "named_near", "harmless_near", "digest_near", "words_near")


class Language:
    """What all words of a corpus say: a dictionary as a table, and the cost of each pair of letters in bits.

    The driver gets one number for each of the 26 x 26 pairs and the VOCABULARY most frequent words.
    """

    def __init__(self, docs: DataFrame, scratch: Scratch):
        self.scratch = scratch
        words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("word <> ''")
        words = scratch.save("secret-words", words.groupBy("word").agg(F.count("*").alias("n")))
        self.dictionary = words.filter((F.length("word") >= 4) & (F.col("n") >= WORD_COUNT)).select("word")
        top = words.filter("length(word) BETWEEN 3 AND 12").orderBy(F.desc("n"), "word").limit(VOCABULARY)
        self.vocabulary = [r.word for r in top.collect()]
        pairs = words.select("n", F.explode(F.regexp_extract_all("word", F.lit("(?=(..))"), F.lit(1))).alias("pair"))
        counts = {r.pair: r.n for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
        letters = "abcdefghijklmnopqrstuvwxyz"
        rows = {x: sum(counts.get(x + y, 0) for y in letters) for x in letters}
        self.bits = [-log2((counts.get(x + y, 0) + 0.5) / (rows[x] + 13)) for x in letters for y in letters]

    def improbable(self, text: Column) -> Column:
        """Mean bits of the pairs of letters in `text`; the mean of all pairs where it has none."""
        pairs = F.regexp_extract_all(F.lower(text), F.lit("(?=([a-z]{2}))"), F.lit(1))
        # read from one text: an array of literals has an object on the driver for each value, in every use and every phase of a plan
        cost = F.from_json(F.lit(json.dumps(self.bits)), "array<double>")
        at = lambda pair: (F.ascii(pair) - 97) * 26 + F.ascii(F.substring(pair, 2, 1)) - 97
        total = let(pairs, lambda x: F.aggregate(x, F.lit(0.0), lambda a, pair: a + F.get(cost, at(pair))) / F.nullif(F.size(x), F.lit(0)))
        return F.coalesce(total, F.lit(sum(self.bits) / len(self.bits)))

    def with_cover(self, found: DataFrame, name: str) -> DataFrame:
        """`found` and `covered`: the share of each value that words of the dictionary make up."""
        values = found.select("value").distinct()
        pieces = values.select("value", F.explode(F.regexp_extract_all("value", F.lit("[A-Z]?[a-z]{3,}|[A-Z]{4,}"), F.lit(0))).alias("piece"))
        known = pieces.withColumn("word", F.lower("piece")).join(self.dictionary, "word").groupBy("value").agg(
            F.sum(F.length("word")).alias("known"))
        known = self.scratch.save(name, known)
        return found.join(known, "value", "left").withColumn(
            "covered", F.coalesce(F.col("known") / F.char_length("value"), F.lit(0.0))).drop("known")


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, mark, at, start, value, before, after, path) of every candidate; `at` counts them in a document."""
    with_path = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    cut = docs.select("doc_id", F.xxhash64("text").alias("mark"), with_path.alias("path"),
                      F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"),
                      F.split("text", CANDIDATE, -1).alias("between")).filter(F.size("values") > 0)
    one = cut.select("doc_id", "mark", "path", "between", "values", F.posexplode("values").alias("at", "value"))
    lengths = F.aggregate(F.slice("between", 1, F.col("at") + 1), F.lit(0), lambda n, x: n + F.char_length(x)) + F.aggregate(
        F.slice("values", 1, F.col("at")), F.lit(0), lambda n, x: n + F.char_length(x))
    left, right = F.get("between", F.col("at")), F.get("between", F.col("at") + 1)
    return one.select("doc_id", "mark", "path", "at", lengths.alias("start"), "value",
                      F.right(left, F.lit(NEAR)).alias("before"), F.left(right, F.lit(NEAR)).alias("after"))


def with_features(found: DataFrame, language: Language, name: str) -> DataFrame:
    found = language.with_cover(found, f"secret-cover-{name}")
    value = F.col("value")
    size = F.char_length(value)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[a-z]", "l"), "[A-Z]", "U"), "[0-9]", "0"), "[^lU0]", "-")
    characters = F.split(value, "")
    distinct = F.array_distinct(characters)

    def share(pattern: str, text=value) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size

    def entropy() -> Column:
        def term(c):
            p = (size - F.char_length(F.replace(value, c, F.lit("")))) / size
            return F.when(c == "", F.lit(0.0)).otherwise(-p * F.log2(p))
        return F.aggregate(F.transform(distinct, term), F.lit(0.0), lambda a, x: a + x)

    def yes(condition) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    near = F.concat_ws(" ", "before", "after")
    columns = {
        "size": size.cast("double"),
        "class_changes": F.regexp_count(classes, F.lit(r"(.)(?!\1)(?=.)")) / size,
        "vowel_changes": share("[aeiou](?=[^aeiou])|[^aeiou](?=[aeiou])", F.lower(value)),
        "entropy": entropy(), "distinct": F.size(distinct) / size,
        "improbable": language.improbable(value), "digits": share("[0-9]"), "capitals": share("[A-Z]"),
        "hexadecimal": yes(value.rlike("^[0-9a-f-]+$|^[0-9A-F-]+$")), "separators": share("[-_/.]"),
        "longest": F.array_max(F.transform(F.split(value, "[-_/.]"), lambda x: F.char_length(x))) / size,
        "dated": yes(value.rlike(DATE)),
        "path_harmless": yes(F.col("path").rlike(HARMLESS)),
        "path_config": yes(F.col("path").rlike(r"(?i)\.env|config|settings|\.ya?ml|\.pem|\.key")),
        "assigned": yes(F.col("before").rlike(ASSIGNED)),
        "sign_before": yes(F.col("before").rlike(r"[=:]\s{0,3}[\"']?$")),
        "quoted": yes(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "named_near": yes(near.rlike(f"(?i){NAMES}")), "harmless_near": yes(near.rlike(HARMLESS)),
        "digest_near": yes(near.rlike(DIGEST)),
        "words_near": F.regexp_count(near, F.lit(r"\b[a-z]{2,8}\b")).cast("double"),
    }
    return found.withColumns(columns)


def self_labelled() -> Column:
    """1 or 0 for findings that label themselves, else NULL."""
    assigned, worded = F.col("assigned") == 1, F.col("covered") >= 0.3
    uuid = F.col("value").rlike(UUID)
    secret = (F.col("value").rlike(KNOWN) | (assigned & (F.col("digits") > 0) & ~uuid & ~worded)) & (F.col("harmless_near") == 0)
    dated = (F.col("dated") == 1) & (F.col("separators") > 0)
    harmless = (F.col("digits") == 1) | worded | (~assigned & (uuid | dated | (F.col("texts") >= REPEATED)))
    return F.when(secret, 1.0).when(harmless, 0.0)


def bare(found: DataFrame) -> DataFrame:
    """The same values without the name and the sign that they are assigned to, and without quotes."""
    return (found.withColumn("before", F.regexp_replace("before", r"[\w.\-]*[\"']?\s{0,3}[=:]?\s{0,3}[\"']?$", ""))
            .withColumn("after", F.regexp_replace("after", "^[\"']", "")))


def built(docs: DataFrame, vocabulary: list[str], n: int) -> DataFrame:
    """(value, before, after, path, label): n examples of all kinds, from words of the corpus and hashes of their numbers."""
    words = F.split(F.lit(" ".join(vocabulary)), " ")  # one literal, for the driver's memory

    def draw(k: int, below: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(below)).cast("int")

    def w(k: int) -> Column:
        return F.get(words, draw(k, len(vocabulary)))

    def digits(k: int, size: int) -> Column:
        return F.lpad(draw(k, 10 ** size).cast("string"), size, "0")

    def hexes(k: int) -> Column:
        return F.sha2(F.concat_ws(":", "id", F.lit(k)), 256)

    def key(shortest: int, room: int) -> Column:
        return F.substring(F.translate(F.base64(F.unhex(hexes(1))), "+/=", "kQ7"), F.lit(1), F.lit(shortest) + draw(2, room))

    def pick(k: int, *of) -> Column:
        return F.get(F.array(*[F.lit(x) if isinstance(x, str) else x for x in of]), draw(k, len(of)))

    def joined(sign: str, *of) -> Column:
        return F.concat_ws(sign, *[F.lit(x) if isinstance(x, str) else x for x in of])

    h = hexes(3)
    uuid = joined("-", *[F.substring(h, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    day = joined("-", F.concat(F.lit("20"), digits(4, 2)), F.lpad((draw(5, 12) + 1).cast("string"), 2, "0"), F.lpad((draw(6, 28) + 1).cast("string"), 2, "0"))
    part = F.concat(pick(7, "part-", "v", "run-", "file_", ""), digits(8, 4))
    path = pick(9, joined("/", "", w(10), w(11), w(12), day, part), joined("/", "", w(10), w(11), joined("-", w(12), part)),
                joined("/", w(10), w(11), w(12), part), joined("/", "", w(10), w(11), w(12), w(13), w(14)),
                joined("/", "", w(10), w(11), F.substring(h, 1, 8), day, part))
    name = pick(9, joined("_", w(10), w(11), w(12), digits(13, 2)), F.concat(w(10), F.initcap(w(11)), F.initcap(w(12)), digits(13, 3)),
                joined("-", w(10), w(11), w(12), digits(13, 4)), joined("_", w(10), w(11), w(12), w(13)))
    date = pick(9, joined("-", w(10), F.translate(day, "-", ""), digits(11, 6)), joined("_", day, digits(11, 6), w(10)),
                joined("-", w(10), digits(12, 1), digits(13, 2), digits(14, 1), "build", F.translate(day, "-", "")))
    digest = F.substring(h, F.lit(1), pick(9, "32", "40", "64").cast("int"))
    plain = F.concat(w(20), F.lit(" "), w(21), F.lit(" "))
    signed = F.concat(w(20), F.lit(" "), w(21), pick(22, "=", ": ", " = ", " = \"", "_id="))
    secret = F.concat(w(20), F.lit(" "), pick(23, "password", "token", "api_key", "secret", "access_key", "auth_token"), pick(22, "=", ": ", " = ", " = \""))
    hashed = F.concat(w(20), F.lit(" "), pick(23, "sha256", "checksum", "commit", "md5", "digest", "revision", "hash"), pick(22, " ", "=", ": "))
    known = pick(9, F.concat(F.lit("AKIA"), F.upper(F.substring(h, 1, 16))), F.concat(F.lit("ghp_"), F.substring(F.translate(F.base64(F.unhex(h)), "+/=", "kQ7"), 1, 36)))
    kinds = [(uuid, plain, 0), (uuid, signed, 0), (path, plain, 0), (path, signed, 0), (name, plain, 0), (name, signed, 0), (date, plain, 0),
             (date, signed, 0), (digest, hashed, 0), (joined("-", w(10), w(11), w(12)), secret, 0),
             (key(16, 29), plain, 1), (key(16, 29), signed, 1), (key(16, 29), secret, 1), (digest, secret, 1), (known, plain, 1), (key(9, 8), secret, 1)]
    of = F.get(F.array(*[F.struct(v.alias("value"), b.alias("before"), F.lit(float(x)).alias("label")) for v, b, x in kinds]),
               F.pmod("id", F.lit(len(kinds))).cast("int"))
    rows = docs.sparkSession.range(n if vocabulary else 0).select(of.alias("of"), F.concat(F.lit(" "), w(24), F.lit(" "), w(25)).alias("after"))
    quoted = F.col("of.before").rlike("\"$")
    return rows.select("of.value", "of.before", F.when(quoted, F.concat(F.lit("\""), "after")).otherwise(F.col("after")).alias("after"),
                       F.lit(None).cast("string").alias("path"), "of.label")


def scan(docs: DataFrame, findings: DataFrame | None = None, path: str = "source", max_findings: int = MAX_FINDINGS,
         threshold: float = 0.5, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, mark, at, start, length, sha256, rule, score, is_secret): one row per candidate.

    `findings` are labelled examples: value, before, after, path (strings) and label
    (0 or 1); at most `max_findings` are learnt from, repeats left out, those of the
    lowest hash: half of each label, or more where the other has fewer. Without them
    the corpus gives the examples (see above), and BUILT ones are added. With
    examples of one kind only, a candidate is a secret if its format or the name it is
    assigned to says so. NULL and empty texts have no candidates; rows that repeat id
    and text give the same rows again; positions count characters from 0.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    language = Language(docs, scratch)
    found = scratch.save("secret-found", candidates(docs, path))
    featured = scratch.save("secret-candidates", with_features(found, language, "found"))
    scratch.drop("secret-found", "secret-cover-found")
    columns = ["value", "before", "after", "path", "label"]
    extra = built(docs, language.vocabulary, BUILT)
    if findings is None:
        texts = scratch.save("secret-repeats", featured.groupBy("value").agg(F.count_distinct("mark").alias("texts")).filter(
            F.col("texts") >= REPEATED))
        labelled = featured.join(texts, "value", "left").withColumn("label", self_labelled()).select(*columns).filter("label IS NOT NULL")
        labelled = labelled.unionByName(bare(labelled.filter("label = 1"))).distinct()
        extra = with_features(scratch.save("secret-built", extra), language, "built").select("label", *FEATURES)
    else:
        labelled, extra = findings.select(*columns[:4], F.col("label").cast("double").alias("label")), None
    examples = with_features(labelled, language, "labelled")
    order = F.xxhash64("value", "before", "after")
    # copies count once, so that a hot finding does not fill the sample
    examples = scratch.save("secret-labelled", examples.filter("label IS NOT NULL").select("label", *FEATURES, order.alias("order")).distinct())
    sizes = {r.label: r["count"] for r in examples.groupBy("label").count().collect()}

    def sample(label: float) -> DataFrame:
        room = max(max_findings // 2, max_findings - sizes.get(1.0 - label, 0))
        return examples.filter(F.col("label") == label).orderBy("order", *FEATURES).limit(room)

    examples = sample(1.0).unionByName(sample(0.0)).select("label", *FEATURES)
    examples = scratch.save("secret-examples", examples.unionByName(extra) if extra is not None else examples)
    scratch.drop("secret-labelled", "secret-repeats", "secret-built", "secret-cover-labelled", "secret-cover-built", "secret-words")
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    rule = F.when(F.col("value").rlike(KNOWN), "known format").when(F.col("assigned") == 1, "assigned to a name").otherwise("opaque run")
    if examples.select("label").distinct().count() == 2:
        # both kinds weigh the same
        n = {r.label: r["count"] for r in examples.groupBy("label").count().collect()}
        weighted = examples.withColumn("weight", F.when(F.col("label") == 1, 1.0 / n[1.0]).otherwise(1.0 / n[0.0]) * sum(n.values()) / 2)
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight",
                                        featureSubsetStrategy="sqrt").fit(vector.transform(weighted))
        scored = forest.transform(vector.transform(featured)).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = featured.withColumn("score", (F.col("value").rlike(KNOWN) | (F.col("assigned") == 1)).cast("double"))
    return scored.select("doc_id", "mark", "at", "start", F.char_length("value").alias("length"),
                         F.sha2("value", 256).alias("sha256"), rule.alias("rule"), F.round("score", 6).alias("score"),
                         (F.col("score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, **parameters) -> DataFrame:
    """`docs` with every secret replaced by a placeholder; `n_chars`, if there, follows.

    No document goes; all other columns stay, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    found = scan(docs, scratch=scratch, **parameters).filter("is_secret")
    found = scratch.save("secrets", found.groupBy(F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark"))
                         .agg(F.collect_set("at").alias("__secret")))
    scratch.drop("secret-candidates", "secret-examples")
    joined = docs.withColumn("__own", F.xxhash64("text")).join(
        found, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__own") == F.col("__mark")), "left")
    values = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    shown = F.transform(values, lambda v, i: F.when(F.array_contains("__secret", i), F.lit(REDACTED)).otherwise(v))
    pieces = F.zip_with(F.split("text", CANDIDATE, -1), shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    hit = F.col("__secret").isNotNull()
    joined = joined.withColumn("text", F.when(hit, F.array_join(pieces, "")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                                   .otherwise(F.col("n_chars")))
    return joined.select([f"`{c}`" for c in docs.columns])


@query("op6_secret_scan")
def op6_secret_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir)).drop("mark", "at")
