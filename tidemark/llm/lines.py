"""Fuzzy line de-duplication by MinHash. DataFrame operations only.

Lines are compared in lower case without white space at their ends, as sets of
`width`-character shingles (a shorter line is one shingle).

1. Equal lines are grouped; only distinct lines go on.
2. Signature: the sorted hashes of the line's anchors. An anchor is a word
   with the start of the next one; of a word of over LONG_WORD characters the
   shingles of the rest are anchors too, so text without spaces has them as well.
   The choice depends on the characters next to it alone, so similar lines draw
   alike. `size` / 2 points are set in the range of hashes, and the `rows` anchors
   that follow a point (around the end, if need be) are a band: two lines share it
   if none of the first `rows` of what either has there is its own, so at
   similarity t with probability t ** rows, nearly independent of other bands.
   Of under ALL_RUNS anchors all runs of `rows` neighbours are bands.
   A line of under SHORT characters, or of fewer than `size` anchors, has, besides,
   bands at `size` points of the hashes of all its shingles (at 0.8 one pair in
   thousands shares none). With under ALL_RUNS shingles it has all runs of `rows`
   neighbours instead, and two such lines always meet: of lines with s common
   shingles and b others, s >= 4 b, the b others cut the s common ones into b + 1
   runs at most, so one has four neighbours, or three or two where the sets are as
   small as FEW says.
3. Lines in one band are candidates. The first line of the band is compared with
   all others; that connects most bands. Of the others of a band that it does not
   connect all pairs of different components are compared, if it has no more than
   ALL_PAIRS lines. Lines of larger ones
   meet anew by rare shingles: with the shingles of each line ordered by the number
   of such lines that have them, rarest first, two sets with similarity t share one
   of the first n - ceil(t n) + 1, and its place in both bounds what they can have
   in common. So copies of a template part by what is their own, and every similar
   pair of a band is connected or is compared here. Of lines that share a rare
   shingle, LEADERS are compared with all others, one after another, and then all
   of different components with each other.
4. Comparison is exact: the Jaccard similarity of the sets of all shingles (as 32
   bits of hash), which are computed once for each candidate.
5. Union-find over the links; the first line of a component stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, documents, let
from tidemark.llm.registry import query

WIDTH, SIZE, ROWS, SIMILARITY = 8, 16, 4, 0.8
BLANK = " \t\r\x0b\x0c"
#: Lines of fewer characters have bands of all shingles; of longer words more than the start is an anchor.
SHORT, LONG_WORD = 100, 32
#: Fewer shingles or anchors than this have all runs of neighbours as bands.
ALL_RUNS = 24
#: Lines with fewer shingles than this also have runs of this many neighbours (for a similarity of 0.8).
FEW = {3: 16, 2: 6}
#: Lines of a group that are compared with all others before all pairs of different components are; no effect on results.
LEADERS = 3
#: Unconnected bands of up to so many lines are compared pair by pair, without rare shingles; no effect on results.
ALL_PAIRS = 16
MARK = "mark"  # with doc_id it names a document: rows that repeat id and text are one


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, line_no, line): every line with a word, in lower case and without white space at its ends."""
    return (docs.select("doc_id", F.xxhash64("text").alias(MARK), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
            .withColumn("line", F.lower(F.btrim("line", F.lit(BLANK)))).filter("line <> ''"))


def shingle_set(line: str, width: int):
    """Distinct hashes of all shingles of a line; four bytes a character, so any of them is found at once."""
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(line) - width, F.lit(0)))
    return F.array_distinct(let(F.encode(line, "UTF-32"), lambda wide: F.transform(
        starts, lambda i: F.hash(F.substring(wide, i * 4 + 1, F.lit(4 * width))))))


def anchored_hashes(line: str, width: int):
    """Distinct hashes of the words, each with the start of the next, and of the shingles far inside long words."""
    def anchors(words):
        starts = F.transform(words, lambda word, i: F.hash(word, F.substring(F.get(words, i + 1), 1, 3)))
        rest = F.transform(F.filter(words, lambda word: F.char_length(word) > LONG_WORD),
                           lambda word: shingle_set(F.substr(word, F.lit(LONG_WORD - width + 1)), width))
        return F.concat(starts, F.flatten(rest))

    return F.array_distinct(let(F.split(line, " "), anchors))


def runs(signature, rows: int):
    """Hashes of all runs of `rows` neighbours in the signature; a shorter one is one run."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(signature) - rows + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(signature, i, F.lit(rows))))


def at_points(hashes, number: int, rows: int):
    """For `number` points in the range of 32 bits, hashes of the `rows` sorted `hashes` that follow it, around the end."""
    points = [-(1 << 31) + (i << 32) // number for i in range(number)]
    around = F.concat(hashes, F.slice(hashes, 1, rows))
    # among hashes and points, a point has as many hashes before it as its place less the points before it
    merged = F.sort_array(F.concat(hashes, F.array(*[F.lit(p) for p in points])))
    return let(F.struct(around.alias("around"), merged.alias("merged")), lambda x: F.transform(
        F.array(*[F.lit(p) for p in points]), lambda p, i: F.xxhash64(F.slice(
            x["around"], (F.array_position(x["merged"], p) - i).cast("int"), F.lit(rows)))))


def line_bands(lines: DataFrame, width: int, size: int, rows: int) -> DataFrame:
    """(id, bands): distinct hashes of the bands of the anchors and, for a short line, of those of all shingles."""
    none = F.array().cast("array<bigint>")

    def whole(hashes):
        fewer = [F.when(F.size(hashes) < below, runs(hashes, n)).otherwise(none) for n, below in FEW.items() if n < rows]
        return F.when(F.size(hashes) < ALL_RUNS, F.concat(runs(hashes, rows), *fewer)).otherwise(at_points(hashes, size, rows))

    # a step for each sorted array, so that it is computed once and by generated code
    is_short = (F.char_length("line") < SHORT) | (F.size("anchors") < size)
    steps = (lines.select("id", "line", F.sort_array(anchored_hashes("line", width)).alias("anchors"))
             .select("id", "anchors", F.when(is_short, F.sort_array(shingle_set("line", width))).alias("shingles")))
    short = F.when(F.col("shingles").isNotNull(), let(F.col("shingles"), whole)).otherwise(none)
    # eight points on few anchors would miss more pairs than all runs
    anchored = F.when(F.size("anchors") < ALL_RUNS, runs(F.col("anchors"), rows)).otherwise(at_points(F.col("anchors"), size // 2, rows))
    return steps.select("id", F.array_distinct(F.concat(anchored, short)).alias("bands"))


def links(lines: DataFrame, width: int, size: int, rows: int, similarity: float) -> DataFrame:
    """(a, b) of line ids whose similarity reaches the threshold; enough of them to connect what all would."""
    scratch = Scratch(lines.sparkSession)
    # a row for each line, so its id is written once
    banded = scratch.save("line-bands", line_bands(lines, width, size, rows)).select("id", F.explode("bands").alias("band"))
    # bands with one line only end here; a line has a band once, so it is enough to move the bands and their counts
    shared = scratch.save("line-shared", banded.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1"))
    members = scratch.save("line-members", banded.join(shared.select("band", "first"), "band"))
    scratch.drop("line-bands", "line-shared")
    sets = scratch.save("line-sets", lines.select("id", "line").join(members.select("id").distinct(), "id")
                        .select("id", shingle_set("line", width).alias("shingles")).withColumn("n", F.size("shingles")))
    n_sets = sets.count()

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        """The rows of `pairs`, which have lines `a` and `b`, that are similar."""
        sizes = sets.select("id", "n")
        # a set cannot be similar to one that is much larger, so such pairs end before the sets are fetched
        sized = scratch.save("line-pairs", pairs.join(sizes.withColumnsRenamed({"id": "a", "n": "na"}), "a")
                             .join(sizes.withColumnsRenamed({"id": "b", "n": "nb"}), "b")
                             .filter(F.least("na", "nb") >= similarity * F.greatest("na", "nb")))
        # pairs carry their sets, so they go in as many turns as it takes for a turn to carry no more of them than there are sets
        turns = max(1, -(-sized.count() // (n_sets + 1)))
        found = []
        for turn in range(turns):
            some = sized.filter(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn) if turns > 1 else sized
            both = (some.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
                    .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"))
            jaccard = let(F.size(F.array_intersect("x", "y")), lambda common: common / (F.col("na") + F.col("nb") - common))
            found.append(scratch.save(f"{name}-{turn}", both.filter(jaccard >= similarity).select(*pairs.columns)))
        return reduce(DataFrame.unionByName, found)

    found = [compare(members.filter("first < id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "line-links-0")]
    labels = scratch.save("line-labels", lower_labels(found[0]).toDF("id", "component"))
    labelled = scratch.save("line-labelled", members.join(labels, "id", "left").select(
        "band", "first", "id", F.coalesce("component", "id").alias("component")))
    scratch.drop("line-members", "line-labels")
    mixed = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    mixed = scratch.save("line-mixed", mixed.filter("low < high AND n > 2").select("band", "n"))
    # the first line was compared with all others
    few = labelled.filter("first < id").join(mixed.filter(F.col("n") <= ALL_PAIRS).select("band"), "band").select("band", "id", "component")
    pairs = (few.select("band", F.col("id").alias("a"), F.col("component").alias("ca"))
             .join(few.select("band", F.col("id").alias("b"), F.col("component").alias("cb")), "band").filter("a < b AND ca <> cb"))
    found.append(compare(pairs.select("a", "b").distinct(), "line-links-few"))
    many = mixed.filter(F.col("n") > ALL_PAIRS).select("band")
    unconnected = scratch.save("line-unconnected", labelled.join(many, "band").select("id", "component").distinct())
    scratch.drop("line-labelled", "line-mixed")
    if unconnected.isEmpty():
        scratch.drop("line-unconnected", "line-sets", "line-pairs")
        return reduce(DataFrame.unionByName, found)
    groups = scratch.save("line-groups-0", rare_groups(scratch, unconnected, sets, similarity))
    scratch.drop("line-unconnected", "line-shingle-counts")
    for step in range(1, LEADERS + 2):
        others = groups.select("shingle", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("after").alias("after_b"))
        leaders = groups
        if step <= LEADERS:
            leader = scratch.save("line-leaders", groups.groupBy("shingle").agg(F.min_by("id", F.xxhash64("id", F.lit(step))).alias("id")))
            leaders = groups.join(leader, ["shingle", "id"])
        leaders = leaders.select("shingle", F.col("id").alias("a"), F.col("component").alias("ca"), "n", "after")
        # shingles in common are at most this one and what follows it in the shorter rest
        may_reach = (F.least("after", "after_b") + 1) * (1 + similarity) >= similarity * (F.col("n") + F.col("nb")) - 1e-6
        once = F.col("a") < F.col("b") if step > LEADERS else F.lit(True)
        pairs = others.join(leaders, "shingle").filter(once & (F.col("ca") != F.col("cb")) & may_reach)
        similar = compare(pairs.select("a", "b", "ca", "cb").distinct(), f"line-similar-{step}")
        # components are joined by their labels, so the next round works on few links
        joined = scratch.save(f"line-links-{step}", similar.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        found.append(joined)
        if step <= LEADERS:
            moved = lower_labels(joined)
            groups = scratch.save(f"line-groups-{step}", groups.join(moved, "component", "left").select(
                "shingle", "id", F.coalesce("moved", "component").alias("component"), "n", "after"))
            scratch.drop(f"line-groups-{step - 1}", "line-leaders")
    scratch.drop("line-sets", "line-pairs", f"line-groups-{LEADERS}")
    return reduce(DataFrame.unionByName, found)


def lower_labels(joined: DataFrame) -> DataFrame:
    """(component, moved) from links (a, b) of components: the least label within two stars, so the two belong together.

    Stars become one, longer chains need not: before and between rounds this only spares
    comparisons, and the links are kept for the union-find at the end. It is one
    plan, where a union-find is a dozen of them.
    """
    labels = joined.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    for end, other in (("b", "a"), ("a", "b")) * 2:
        # labels of one end of the links go to the other end, to leaders first
        near = joined.join(labels.withColumnRenamed("node", end), end).select(F.col(other).alias("node"), "label")
        labels = labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label"))
    return labels.select(F.col("node").alias("component"), F.col("label").alias("moved"))


def rare_groups(scratch: Scratch, lines: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(shingle, id, component, n, after): lines by those rare shingles that lines of other components have too.

    `after` counts the shingles of the line that come later in the order. Any
    order of the shingles gives the same links in the end; this one makes the
    groups small. Shingles that only lines of one component have come first in it:
    they cannot be in common, so they are counted and do not move, and a line with
    too few others is in no group.
    """
    own = lines.join(sets, "id").select("id", "component", "n", F.explode("shingles").alias("shingle"))
    counts = own.groupBy("shingle").agg(F.count("*").alias("lines"), F.min("component").alias("low"), F.max("component").alias("high"))
    # the place in the order and the shingle are one number, as numbers are sorted faster than structures
    low32 = F.lit((1 << 32) - 1)
    key = F.shiftleft(F.least("lines", F.lit((1 << 31) - 1)), 32).bitwiseOR(F.col("shingle").cast("long").bitwiseAND(low32))
    counts = scratch.save("line-shingle-counts", counts.filter("low < high").select("shingle", key.alias("key")))
    ordered = own.join(counts, "shingle").groupBy("id", "component", "n").agg(
        F.sort_array(F.collect_list("key")).alias("order")).withColumn("m", F.size("order"))
    prefix = F.slice("order", F.lit(1), F.greatest(F.col("m") - F.ceil(F.col("n") * similarity - 1e-6) + 1, F.lit(0)).cast("int"))
    return ordered.select("id", "component", "n", "m", F.posexplode(prefix).alias("at", "key")).select(
        F.col("key").bitwiseAND(low32).alias("shingle"), "id", "component", "n", (F.col("m") - F.col("at") - 1).alias("after"))


def line_classes(docs: DataFrame, width: int = WIDTH, size: int = SIZE, rows: int = ROWS,
                 similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, mark, line_no, first_doc_id, first_mark, first_line_no, kept) of every line with a word.

    Lines of a component share the `first_` columns, which name the line that is
    kept: the least by doc_id (NULL first), mark and number. A NULL or empty text
    has no lines; lines of white space only are not listed and stay. Rows that
    repeat both id and text count as one document.
    """
    scratch = Scratch(docs.sparkSession)
    occurrences = line_rows(docs)
    distinct = scratch.save("lines", occurrences.groupBy("line").agg(F.count("*").alias("n"))
                            .withColumn("id", F.monotonically_increasing_id()))
    found = links(distinct, width, size, rows, similarity)
    labels = scratch.save("line-components", components(found, "lines"))
    # equal lines meet by 128 bits of hash, so that texts do not move again
    h1, h2 = F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    known = distinct.select("id", "n", h1, h2).join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "h1", "h2", F.coalesce("component", "id").alias("component"), F.col("component").isNotNull() | (F.col("n") > 1))
    known = scratch.save("line-known", known.toDF("h1", "h2", "component", "shared"))
    scratch.drop("lines", "line-components")
    marked = occurrences.select("doc_id", MARK, "line_no", h1, h2)
    placed = scratch.save("line-places", marked.join(known, ["h1", "h2"]).select("doc_id", MARK, "line_no", "component", "shared"))
    scratch.drop("line-known")
    place = F.struct("doc_id", MARK, "line_no")
    first = scratch.save("line-first", placed.filter("shared").groupBy("component").agg(F.min(place).alias("first")))
    return placed.join(first, "component", "left").withColumn("first", F.coalesce("first", place)).select(
        "doc_id", MARK, "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col(f"first.{MARK}").alias("first_mark"),
        F.col("first.line_no").alias("first_line_no"), (F.col("first") == place).alias("kept"))


def without_repeated_lines(docs: DataFrame, **parameters) -> DataFrame:
    """`docs` without the lines that are not kept; `n_chars`, if there, follows.

    All other columns stay, whatever their names. A document that had words and
    has none left goes; one without any words before stays as it is.
    """
    scratch = Scratch(docs.sparkSession)
    gone = line_classes(docs.select("doc_id", "text"), **parameters).filter("NOT kept")
    gone = scratch.save("lines-gone", gone.groupBy("doc_id", MARK).agg(F.collect_set("line_no").alias("gone")))
    gone = gone.select(F.col("doc_id").alias("__doc_id"), F.col(MARK).alias("__mark"), F.col("gone").alias("__gone"))
    joined = docs.withColumn("__own", F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__own") == F.col("__mark")), "left")
    left = let(F.split("text", "\n", -1), lambda lines: F.transform(F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1), "__gone"), lambda i: F.get(lines, i)))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    joined = joined.withColumn("text", text).filter(
        F.col("__gone").isNull() | (F.btrim("text", F.lit(BLANK + "\n")) != ""))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return joined.select([f"`{c}`" for c in docs.columns])


@query("op1_line_dedup")
def op1_line_dedup(spark, sf_dir):
    return line_classes(documents(spark, sf_dir)).drop("mark", "first_mark")
