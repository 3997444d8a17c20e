import json
import random
import shutil
import struct
import zlib
from contextlib import contextmanager

import pytest
from conftest import CATALOG, catalog_row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import delimited, documents, fallback, images, inventory, jdbc, listing, paged
from tidemark.sources.collections import change, cut
from tidemark.sources.quoted import ends_inside
from tidemark.sources.events import dead_letters, decode_events, good_events
from tidemark.session import materialise
from tidemark.sinks.events import encode_events
from tidemark.sinks.published import PublishedTable

SIMPLE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("year", T.IntegerType())])

RAGGED = '''id,name,year
1,a,2000
2,b,2001,

3,c,2002,,
4,NA,2003
5,"",2004
6,null,1
7,x
8,,5
9,q,1,zz
10,"d,e ""q"", f",7
11,"m,n",8,
12,a,1,2,3
'''


def test_ragged_lines(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text(RAGGED)
    df = delimited.read_lenient(spark, str(tmp_path / "r.csv"), SIMPLE)
    expected = [(1, "a", 2000), (10, 'd,e "q", f', 7), (4, None, 2003), (5, None, 2004), (6, None, 1), (7, "x", None), (8, None, 5)]
    assert rows(df) == sorted(expected, key=repr)
    # the decision does not depend on the columns that are read
    assert df.count() == 7 and sorted(r[0] for r in df.select("id").collect()) == [1, 4, 5, 6, 7, 8, 10]


BROKEN = ('id,name,year\r\n1,"two\nlines, ""here""",5\n2,5" wide,6\n3,"opens ""\n\n, again""",7\n4,"x"y",8\n'
          '5,"a\nb",9,too,"many\nfields"\n\n6,"' + "long, quoted ""text"" \n" * 40 + '",10\n7,plain,11\n8,"\n",\n9,é"\n10,"never closed\n1')


@contextmanager
def splits_of(spark, size):
    """Files are read in splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    try:
        for name in names:
            spark.conf.set(name, str(size))
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


@pytest.mark.parametrize("size", [60, 300, 10_000])
def test_quoted_line_breaks_whatever_the_splits(spark, tmp_path, rows, size):
    (tmp_path / "q.csv").write_text(BROKEN, newline="")
    (tmp_path / "r.csv").write_text(RAGGED)
    with splits_of(spark, size):
        df = delimited.read_lenient(spark, str(tmp_path / "q.csv"), SIMPLE, na_texts=[])
        assert rows(df) == sorted([
            (1, 'two\nlines, "here"', 5), (2, '5" wide', 6), (3, 'opens "\n\n, again"', 7), (4, '"x"y"', 8),
            (6, "long, quoted text \n" * 40, 10), (7, "plain", 11), (8, "\n", None), (9, 'é"', None), (10, "never closed\n1", None)], key=repr)
        both = delimited.read_lenient(spark, str(tmp_path), SIMPLE, na_texts=[])
        assert both.count() == 9 + 7
        assert size > 150 or df.rdd.getNumPartitions() > 5


def test_quotes_open_and_close_as_by_a_reader_of_one_line_after_the_other():
    rng = random.Random(6)

    def plain(text, state):
        """Character by character: at the start of a field, in a plain one, in quotes, at a quote inside them."""
        for c in text:
            if state == "quoted":
                state = "quote" if c == '"' else "quoted"
            elif c == ",":
                state = "start"
            elif c == '"' and state in ("start", "quote"):
                state = "quoted"
            else:
                state = "plain"
        return state == "quoted"

    for _ in range(20_000):
        line = "".join(rng.choices('",a""', k=rng.randint(0, 9)))
        assert ends_inside(line, False) == plain(line, "start"), line
        assert ends_inside(line, True) == plain(line, "quoted"), line
    assert not ends_inside('"' + 'a""' * 50_000 + '"', False) and ends_inside("," * 50_000 + '"', False)


def test_typed_file_with_quoted_line_breaks(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text('id,name,year\n1,"two\nlines ""here""",5\n2,b,6\n')
    df = delimited.read_typed(spark, str(tmp_path / "t.csv"), SIMPLE, columns=["id", "name"], multi_line=True)
    assert rows(df) == [(1, 'two\nlines "here"'), (2, "b")]
    assert delimited.read_typed(spark, str(tmp_path / "t.csv"), SIMPLE, limit=1, multi_line=True).count() == 1


def write_catalog(path, *rows):
    head = [c.split()[0] for c in CATALOG.split(", ")]
    lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
    path.write_text("\n".join([",".join(head), *lines]) + "\n")


def test_folder_dedupes_inside_each_file(spark, tmp_path, rows):
    schema = spark.createDataFrame([], CATALOG).schema
    write_catalog(tmp_path / "a.csv", catalog_row(1, " A "), catalog_row(1, "A2"), catalog_row(2, colour=None))
    write_catalog(tmp_path / "b.csv", catalog_row(1, "B"))
    (tmp_path / "notes.txt").write_text("ignored")
    trim = ["productDisplayName"]
    read = lambda scope: delimited.read_folder(spark, str(tmp_path), schema, "id", ["productDisplayName"], trim,
                                               ["baseColour"], scope=scope)
    assert rows(read("file"), "source_file", "id", "productDisplayName", "baseColour") == [
        ("a.csv", 1, "A", "Blue"), ("a.csv", 2, "Blue Shirt", "Unknown"), ("b.csv", 1, "B", "Blue")]
    assert rows(read("all"), "source_file", "id") == [("a.csv", 1), ("a.csv", 2)]


def test_document_collection(spark, tmp_path, rows):
    (tmp_path / "db.json").write_text(
        '{"_default": {"1": {"product_id": 1, "product_name": "x", "rating": 0.7, "review_count": 1},\n'
        ' "2": {"product_id": 2, "product_name": null, "rating": 1.4, "review_count": 2}}}')
    assert rows(documents.read_collection(spark, str(tmp_path / "db.json"))) == [(1, "x", 0.7, 1), (2, None, 1.4, 2)]
    (tmp_path / "lines.json").write_text('{"product_id": 5, "rating": 2.5}\n')
    assert rows(documents.read_document_lines(spark, str(tmp_path / "lines.json"))) == [(5, None, 2.5, None)]


NESTED = {"other": {"1": {"product_id": 100}}, "_default": {
    str(i): {"product_id": i, "product_name": name, "rating": i / 2, "more": {"a": [{}, {"b": "}"}], "c": {"d": {}}}}
    for i, name in enumerate(["x", '{"', '"}', "\\\\", '\\\\"}', "}" * 60, "{" * 60, None, "é\\n", ""])},
    "empty": {}, 'last "{': {"1": {"product_id": 101}, "2": {}}}


@pytest.mark.parametrize("size", [60, 250, 100_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_one_object_is_cut_anywhere(spark, tmp_path, rows, size, indent):
    (tmp_path / "db.json").write_text(json.dumps(NESTED, indent=indent))
    expected = [(d["product_id"], d["product_name"], d["rating"], None) for d in NESTED["_default"].values()]
    with splits_of(spark, size):
        read = documents.read_objects(spark, str(tmp_path), "_default")
        assert size > 250 or read.rdd.getNumPartitions() > 3
        assert rows(documents.read_collection(spark, str(tmp_path))) == sorted(expected, key=repr)
        if size in (60, 100_000):
            assert rows(documents.read_collection(spark, str(tmp_path), table='last "{'), "product_id") == [(101,), (None,)]
            assert documents.read_collection(spark, str(tmp_path), table="empty").count() == 0
            (tmp_path / "more.json").write_text('{"_default": {"1": {"product_id": 7}}}\n{"_default": {"1": {"product_id": 8}}}\n{"_default": {"2": {"pr')
            assert documents.read_collection(spark, str(tmp_path)).count() == len(expected) + 2


def test_cut_equals_a_json_parser_from_any_state():
    rng = random.Random(3)
    for _ in range(400):
        docs = {f"k{i}": {"v": "".join(rng.choices('{}",\\ a', k=rng.randint(0, 6))), "n": {"m": [{}] * rng.randint(0, 2)}}
                for i in range(rng.randint(0, 5))}
        pieces = json.dumps({"a": docs, "b": {"z": {}}}).removesuffix("}").split("}")
        state = (False, 0)
        found = []
        for piece in pieces:  # every piece is a split of its own
            found += cut(iter([piece]), *state)
            in_string, by = change(piece, state[0])
            state = (in_string, state[1] + by)
        text, texts = [], []
        for part, tail, closed, _ in found:
            text = [part] if tail else [*text, part]
            if closed:
                texts.append("}".join(text))
        got = [json.loads("{" + t.lstrip(", ") + "}") for t in texts]
        assert got == [{k: d} for k, d in docs.items()] + [{"z": {}}]


def pages_of(total, fail_at):
    def reader(offset, limit):
        if fail_at is not None and offset == fail_at * limit:
            raise TimeoutError("no answer")
        return [{"id": i, "name": f"n{i}"} for i in range(offset, min(offset + limit, total))]

    return reader


@pytest.mark.parametrize("total, fail_at, kept, errors", [
    (23, None, 23, 0), (20, None, 20, 0), (0, None, 0, 0), (23, 1, 5, 1), (23, 0, 0, 1), (900, None, 900, 0), (900, 150, 750, 1)])
def test_pages_up_to_the_end_or_the_first_failure(spark, total, fail_at, kept, errors):
    got = paged.read_pages(spark, pages_of(total, fail_at), T.StructType(SIMPLE.fields[:2]), page_size=5, wave=8)
    assert sorted(r["id"] for r in got.rows.collect()) == list(range(kept))
    problems = got.errors.collect()
    assert len(problems) == errors and all("TimeoutError" in p["error"] for p in problems)
    assert got.complete == (errors == 0)
    if errors:
        with pytest.raises(RuntimeError, match="TimeoutError"):
            got.require_complete()
    else:
        assert got.require_complete().count() == kept


def test_stored_pages_up_to_the_first_gap(spark, rows):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (3, "d")], "page int, v string")
    got = paged.contiguous_pages(df)
    assert rows(got.rows, "v") == [("a",), ("b",), ("c",)] and not got.complete and rows(got.errors) == [(2, "missing")]
    with pytest.raises(RuntimeError, match="missing"):
        got.require_complete()
    whole = paged.contiguous_pages(df.filter("page < 2"))
    assert whole.complete and whole.require_complete().count() == 3 and whole.errors.count() == 0
    assert not paged.contiguous_pages(df.filter("page > 0")).complete
    assert paged.contiguous_pages(df.filter("page > 9")).complete


def test_kept_answers_are_read_one_partition_a_page(spark, tmp_path, rows):
    answers = spark.createDataFrame([(p, json.dumps([{"id": 3 * p + i, "name": "é"} for i in range(3)])) for p in range(4)] + [(4, "[]")],
                                    "page int, value string")
    answers.write.partitionBy("page").text(str(tmp_path / "kept"))
    reader = paged.StoredPages(str(tmp_path / "kept"))
    got = paged.read_pages(spark, reader, T.StructType(SIMPLE.fields[:2]), page_size=3, wave=2)
    assert got.complete and rows(got.rows) == sorted([(i, "é") for i in range(12)], key=repr)
    spark.dataSource.register(paged.page_source(reader, 3, "kept_pages"))
    read = spark.read.format("kept_pages").options(first=1, pages=2).load()
    assert read.rdd.getNumPartitions() == 2 and rows(read.select("page").distinct()) == [(1,), (2,)]
    shutil.rmtree(tmp_path / "kept" / "page=1")
    got = paged.read_pages(spark, reader, T.StructType(SIMPLE.fields[:2]), page_size=3, wave=2)
    assert not got.complete and rows(got.rows, "id") == [(0,), (1,), (2,)]
    assert [(e.page, "FileNotFoundError" in e.error) for e in got.errors.collect()] == [(1, True)]


def test_many_pages_share_a_partition(spark, rows):
    pages = 40 * spark.sparkContext.defaultParallelism
    got = paged.fetch_pages(spark, pages_of(5 * pages - 7, 9), 5, 3, pages)
    assert rows(got.select("page").distinct()) == [(p,) for p in sorted(range(3, 3 + pages), key=lambda p: repr((p,)))]
    assert sorted(r[0] for r in got.filter("row IS NULL").select("page").collect()) == [9, *range(pages - 1, pages + 3)]
    spark.dataSource.register(paged.page_source(pages_of(100, None), 5, "shared_partitions"))
    read = spark.read.format("shared_partitions").options(first=2, pages=10, at_once=4).load()
    assert read.rdd.getNumPartitions() == 3 and sorted({r.page for r in read.collect()}) == list(range(2, 12))


def test_http_pages_ask_for_offset_and_limit(monkeypatch):
    import io

    asked = []
    monkeypatch.setattr("urllib.request.urlopen", lambda url, timeout: asked.append((url, timeout)) or io.BytesIO(b'[{"id": 1}]'))
    assert paged.HttpPages("http://host/products", gender="Men")(500, 250) == [{"id": 1}]
    assert asked == [("http://host/products?gender=Men&limit=250&offset=500", 5.0)]


def test_fallback_names_the_source_that_answered(spark, tmp_path):
    absent = ("live", lambda: spark.read.parquet(str(tmp_path / "absent")))
    df, mode = fallback.read_with_fallback([absent, ("fallback", lambda: spark.range(3))])
    assert mode == "fallback" and df.select("mode").distinct().first()[0] == "fallback"
    assert fallback.read_with_fallback([("live", lambda: spark.range(1)), absent])[1] == "live"
    assert fallback.read_with_fallback([("live", lambda: spark.range(0)), ("stored", lambda: spark.range(1))])[1] == "stored"
    with pytest.raises(RuntimeError, match="live"):
        fallback.read_with_fallback([absent])


def test_jdbc_scan_is_split_by_ranges():
    options = jdbc.jdbc_options("jdbc:x", "inventory", column="id", bounds=(1, 900), partitions=9, user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "9" and options["user"] == "u"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "900")
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", column="id")


def png(width, height):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    pixels = b"".join(b"\0" + b"\x10\x20\x30" * width for _ in range(height))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(pixels)) + chunk(b"IEND", b""))


def test_image_facts(spark, tmp_path, rows):
    (tmp_path / "a.png").write_bytes(png(6, 4))
    (tmp_path / "broken.png").write_bytes(b"not an image")
    assert rows(images.read_image_facts(spark, str(tmp_path))) == [("a.png", 6, 4, 3)]
    assert rows(images.read_file_facts(spark, str(tmp_path), "*.png"), "file") == [("a.png",), ("broken.png",)]


def test_listing(spark):
    df = spark.range(100).withColumn("gender", F.when(F.col("id") % 2 == 0, "Men").otherwise("Women"))
    keys = lambda page: [r["id"] for r in page.collect()]
    assert keys(listing.list_page(df, "id", limit=3, offset=4)) == [4, 5, 6]
    assert keys(listing.list_page(df, "id", limit=3, gender="Women", other=None)) == [1, 3, 5]
    assert keys(listing.list_after(df, "id", 95)) == [96, 97, 98, 99]
    assert listing.list_page(df, "id").count() == 100
    with pytest.raises(ValueError):
        listing.list_page(df, "id", limit=5001)


def test_find_keys(spark, rows):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    keys = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(listing.find_keys(df, keys, "id")) == [(1, "a", True), (2, None, False)]


def test_inventories(spark, rows):
    spark.range(4).createOrReplaceTempView("inv_one")
    assert rows(inventory.table_inventory(spark, "INV_")) == [("inv_one", 4, 1, "id", "bigint")]
    assert inventory.table_inventory(spark, "no such table").count() == 0
    assert rows(inventory.source_inventory({"n": ("kind", spark.range(2))})) == [("n", "kind", 2, "id")]
    assert inventory.preview(spark.range(9), 3).count() == 3


def test_events_round_trip(spark):
    df = spark.createDataFrame([(7, "Shirts", None, "Fall", "Casual", "Blue Shirt")],
                               "id long, articleType string, baseColour string, season string, usage string, productDisplayName string")
    payload = df.columns[1:]
    when = F.lit("2024-05-01 10:00:00.123456").cast("timestamp")
    records = encode_events(df, "id", payload, "UPDATE", when)
    again = encode_events(df, "id", payload, "UPDATE", when)
    assert records.collect() == again.collect()
    event = good_events(decode_events(records)).first()
    assert (event["key"], event["event_type"], event["product_id"], event["payload"]["baseColour"]) == ("7", "UPDATE", 7, None)
    assert event["event_ts"].isoformat() == "2024-05-01T10:00:00.123456"


def test_bad_records_become_dead_letters(spark):
    texts = ["{", "[]", '{"event_id": "1"}', "", None,
             '{"event_id": "1", "event_type": "MOVE", "product_id": 1, "event_ts": "2024-01-01T00:00:00Z"}',
             '{"event_id": "2", "event_type": "DELETE", "product_id": 1, "event_ts": "2024-01-01T00:00:00Z"}']
    decoded = decode_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert good_events(decoded).count() == 1 and dead_letters(decoded).count() == 6


def test_deep_pages_read_the_keys_between_two_borders(spark, rows, plan):
    df = spark.range(0, 3_000, 3).withColumn("v", F.col("id") % 7).repartition(5)
    borders = materialise(listing.page_borders(df, "id", 100), "borders")
    assert rows(borders) == sorted([(1 + 100 * i, 300 * i) for i in range(10)], key=repr)
    for limit, offset in ((20, 0), (20, 95), (100, 100), (1, 199), (250, 310), (50, 980), (5, 1_000), (5, 5_000), (0, 10)):
        page = listing.page_between_borders(df, borders, "id", limit, offset)
        assert [tuple(r) for r in page.collect()] == [tuple(r) for r in listing.list_page(df, "id", limit, offset).collect()]
    path = f"{materialise(df, 'stored').inputFiles()[0].rsplit('/', 1)[0]}"
    stored = spark.read.parquet(path)
    assert "GreaterThanOrEqual(id,2700)" in plan(listing.page_between_borders(stored, borders, "id", 20, 950))
    assert "LessThan(id,600)" in plan(listing.page_between_borders(stored, borders, "id", 20, 120))
    assert listing.page_between_borders(df.limit(0), borders.limit(0), "id").count() == 0


def test_look_up_reads_the_buckets_of_the_keys(spark, tmp_path, rows):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=40)
    keys = spark.createDataFrame([(7,), (100_000,), (None,)], "id long")
    with pytest.raises(FileNotFoundError):
        listing.find_published(table, keys)
    table.replace(spark.range(2_000).withColumn("v", F.col("id") * 2))
    found = listing.find_published(table, keys)
    assert rows(found) == sorted([(7, 14, True), (100_000, None, False), (None, None, False)], key=repr)
    buckets = {f.split("__bucket=")[1].split("/")[0] for f in found.inputFiles() if "__bucket" in f}
    assert 1 <= len(buckets) <= 3
    assert rows(found) == rows(listing.find_keys(table.read(), keys, "id"))
