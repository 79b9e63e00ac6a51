"""Scalar functions, markup, fingerprints and inventory against Python brute force."""

import hashlib
import json
import tempfile
import os

import pytest
from pyspark.sql import functions as F

from lakeshore.functions import text as tx
from lakeshore.operators import fingerprint, inventory, media, silver
from tests.conftest import SF001


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_sources_without_the_trip_columns_are_refused(spark):
    some = spark.createDataFrame([(1, "2025-01-01", 2.5)], "passenger_count int, tpep_pickup_datetime string, tip_amount double")
    with pytest.raises(ValueError) as caught:
        silver.normalize(some)
    named = str(caught.value).partition(": ")[2].split(", ")
    assert named == [c for c in silver.REQUIRED_COLUMNS if c not in some.columns]
    whole = spark.createDataFrame([], ", ".join(f"{c} string" for c in silver.REQUIRED_COLUMNS))
    assert silver.normalize(whole).columns == list(silver.SILVER_COLUMNS)
    with pytest.raises(ValueError, match="PULocationID$"):
        silver.normalize(whole.withColumnRenamed("PULocationID", "pulocationid_"))


@pytest.mark.parametrize("text,expected", [("4KiB", 4096), ("1MiB", 1048576), ("10", 10), ("1MB", 1000000),
                                           (" 2gib ", 2 * 1024**3), ("4XB", None), ("KiB", None), ("0", None),
                                           ("4k4", None)])
def test_parse_size(spark, text, expected):
    assert _one(spark, tx.parse_size(F.col("s")), text) == expected


def test_file_name_parse(spark):
    ok = _one(spark, tx.parse_trip_file_name(F.col("s")), "yellow_tripdata_2025-01.parquet")
    assert (ok["valid"], ok["taxi_type"], ok["year"], ok["month"]) == (True, "yellow", "2025", "01")
    bad = _one(spark, tx.parse_trip_file_name(F.col("s")), "taxi_2025-01.parquet")
    assert (bad["valid"], bad["taxi_type"]) == (False, None)


def test_month_sequence_30_months(spark):
    months = _one(spark, tx.month_sequence(F.lit("2023-01-01"), F.lit("2025-06-01")), "x")
    assert len(months) == 30 and months[0] == "2023-01" and months[-1] == "2025-06"


def test_require_valid_months_lists_invalid(spark):
    df = spark.createDataFrame([("2024-01",), ("2024-13",), ("24-01",)], "month string")
    with pytest.raises(ValueError, match="2024-13, 24-01"):
        tx.require_valid_months(df)


def test_object_uri_trims_and_rejects_empty(spark):
    assert _one(spark, tx.object_uri(F.lit("b"), F.col("s")), "/a/b/") == "s3a://b/a/b"
    assert _one(spark, tx.object_uri(F.lit("b"), F.col("s")), "//") is None


@pytest.mark.parametrize("q,cat", [("Taxi rank", "taxi"), ("traffic jam", "traffic"), ("public transport", "transport"),
                                   ("Main Street", "street"), ("country road", "street"), ("skyline", "other")])
def test_category(spark, q, cat):
    assert _one(spark, tx.category_from_query(F.col("s")), q) == cat


def test_image_extension(spark):
    df = spark.createDataFrame(
        [("File:A.JPEG", "https://x/y.png", "image/png"), ("File:B", "https://x/y.PNG?x=1", "image/jpeg"),
         ("File:C", "https://x/y", "image/webp"), ("File:D", "https://x/y", "")], "t string, u string, m string")
    got = [r[0] for r in df.select(tx.image_extension("t", "u", "m")).collect()]
    assert got == [".jpg", ".png", ".webp", ".jpg"]


def test_first_non_empty(spark):
    df = spark.createDataFrame([("", "credit"), (None, None), ("artist", "x")], "a string, b string")
    assert [r[0] for r in df.select(tx.first_non_empty("a", "b")).collect()] == ["credit", "", "artist"]


def test_strip_markup(spark):
    cases = {
        None: "", "": "", "plain": "plain", "<b>a&amp;b</b>&#233;&nbsp; x": "a&bé x", "&lt;i&gt; &ampx &am": "<i> &x &am",
        " caf&eacute;\n&#8217;&mdash;&#x41; ": "café ’—A", "a &amp;amp b": "a &amp b", "<p\nclass=x>y</p >": "y", "1 < 2": "1 < 2",
    }
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert [r[0] for r in df.select(media.strip_markup("s")).collect()] == list(cases.values())


def test_metadata_values_of_both_forms(spark):
    payload = ('{"query":{"pages":{"9":{"title":"A","imageinfo":[{"url":"u","mime":"image/png","extmetadata":'
               '{"Artist":"plain <i>text</i>","Credit":{"value":"c&eacute;","source":"x"},"N":{"value":7},"E":{}}}]},'
               '"1":{"title":"B","imageinfo":[{"url":"v","mime":"image/png"}]},"5":{"title":"C"}}}}')
    flat = media.flatten_api_payload(spark.createDataFrame([(payload,)], "payload string"))
    rows = flat.select("title", "page_pos", *[media.metadata_value(F.col("extmetadata"), k).alias(k) for k in ("Artist", "Credit", "N", "E", "Z")])
    assert [tuple(r) for r in rows.orderBy("page_pos").collect()] == [("A", 0, "plain text", "cé", "7", "", ""), ("B", 1, "", "", "", "", "")]


def test_metadata_values_of_any_type(spark):
    """The form is known from the JSON, not from how a text begins."""
    values = {"text": ('"{{PD-old}} <b>x</b>"', "{{PD-old}} x"), "json_text": ('"{\\"value\\": 1}"', '{"value": 1}'), "number": ("7", "7"),
              "fraction": ('{"value":7.5}', "7.5"), "truth": ('{"value":true}', "True"), "null": ("null", ""), "null_value": ('{"value":null}', ""),
              "nothing": ("{}", ""), "list": ('{"value":[1,"x"]}', '[1,"x"]'), "brace": ('{"value":"{a}"}', "{a}")}
    entries = ",".join(f'"{k}":{v}' for k, (v, _) in values.items())
    payload = '{"query":{"pages":{"1":{"title":"A","imageinfo":[{"url":"u","mime":"image/png","extmetadata":{%s}}]}}}}' % entries
    flat = media.flatten_api_payload(spark.createDataFrame([(payload,)], "payload string"))
    row = flat.select(*[media.metadata_value(F.col("extmetadata"), k).alias(k) for k in values]).first()
    assert row.asDict() == {k: want for k, (_, want) in values.items()}


def test_result_fingerprint_of_a_known_result(spark):
    df = spark.createDataFrame([(2, 1.123456789, "2024-01-02"), (1, None, "2024-01-01")],
                               "a int, b double, d string").withColumn("d", F.to_date("d"))
    text = '{"a":1,"b":null,"d":"2024-01-01"}\n{"a":2,"b":1.123457,"d":"2024-01-02"}\n'
    got = fingerprint.result_fingerprint(df).first()
    assert (got["rows_returned"], got["result_sha256"]) == (2, hashlib.sha256(text.encode()).hexdigest())


def test_nested_values_and_timestamps_are_normalised(spark):
    df = spark.sql("SELECT array(1.00000049D, NULL) AS a, named_struct('y', 2.5D, 'x', timestamp_ntz'2025-01-01 10:00:00') AS s, "
                   "map('k', 0.12345678D) AS m, timestamp'2025-01-01 10:00:00.5' AS t")
    assert df.select(fingerprint.normalized_json(df)).first()[0] == (
        '{"a":[1.0,null],"m":{"k":0.123457},"s":{"x":"2025-01-01T10:00:00","y":2.5},"t":"2025-01-01T10:00:00.500000"}')


def test_result_fingerprint_of_an_empty_result(spark):
    got = fingerprint.result_fingerprint(spark.createDataFrame([], "a int")).first()
    assert (got["rows_returned"], got["result_sha256"]) == (0, hashlib.sha256().hexdigest())


def test_different_rows_never_share_a_fingerprint(spark):
    def prints(rows, schema="x string, y string"):
        df = spark.createDataFrame(rows, schema)
        return fingerprint.tree_fingerprint(df).first(), fingerprint.table_fingerprint(df).first()

    tables = [[("a|b", "c")], [("a", "b|c")], [(None, "c")], [("~", "c")], [("", "c")], [("1:a", "")], [("", "1:a")], [("a", "c")] * 2, [("a", "c")],
              [("a", "c"), ("b", "c")], []]
    for kind in (0, 1):
        assert len({tuple(prints(rows)[kind]) for rows in tables}) == len(tables)
    nested = [[([None, "a"],)], [(["a", None],)], [(None,)], [([],)], [([None],)]]
    assert len({tuple(prints(rows, "l array<string>")[0]) for rows in nested}) == len(nested)


def test_tree_fingerprint_is_the_tree_of_its_rows(spark):
    rows = [(i % 700, f"t{i % 11}") for i in range(5000)] + [(0, "hot")] * 2500
    df = spark.createDataFrame(rows, "b int, a string")
    counts = {}
    for b, a in rows:
        key = hashlib.sha256(f"{len(a)}:{a}{len(str(b))}:{b}".encode()).hexdigest()
        counts[key] = counts.get(key, 0) + 1
    level = {key: f"{key}:{n}" for key, n in counts.items()}
    for digits in fingerprint.TREE_LEVELS:
        nodes = {}
        for key, item in level.items():
            nodes.setdefault(key[:digits], []).append(item)
        digests = {key: hashlib.sha256("\n".join(sorted(items)).encode()).hexdigest() for key, items in nodes.items()}
        level = {key: f"{key}:{digest}" for key, digest in digests.items()}
    want = (len(rows), digests[""])
    assert tuple(fingerprint.tree_fingerprint(df).first()) == want
    assert tuple(fingerprint.tree_fingerprint(df.repartition(5).orderBy(F.rand(3))).first()) == want


def test_table_fingerprint_ignores_order_and_partitioning(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    a = fingerprint.table_fingerprint(li).first()
    b = fingerprint.table_fingerprint(li.repartition(7).orderBy(F.rand(1))).first()
    c = fingerprint.table_fingerprint(li.limit(li.count() - 1)).first()
    assert a == b and a != c


def test_file_inventory_matches_hashlib(spark):
    got = {r["file_name"]: r for r in inventory.file_inventory(spark, SF001, "*.parquet").collect()}
    for name in os.listdir(SF001):
        data = open(os.path.join(SF001, name), "rb").read()
        assert got[name]["size_bytes"] == len(data)
        assert got[name]["checksum_sha256"] == hashlib.sha256(data).hexdigest()


def test_files_too_large_for_a_row_are_streamed(spark, scratch):
    for folder in ("a", "b"):
        os.makedirs(f"{scratch}/{folder}")
        with open(f"{scratch}/{folder}/same.bin", "wb") as out:
            out.write(folder.encode() * 5000)
    got = inventory.file_inventory(spark, f"{scratch}/*", "*.bin", row_bytes=100).collect()
    whole = inventory.file_inventory(spark, f"{scratch}/*", "*.bin").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    assert {r["checksum_sha256"] for r in got} == {hashlib.sha256(c * 5000).hexdigest() for c in (b"a", b"b")}


def test_large_files_are_digested_by_executors(spark, scratch, monkeypatch):
    import random
    rng = random.Random(3)
    noise = rng.randbytes(300_000)
    files = {"noise.bin": noise, "closing.bin": noise + b"\n", "newlines.bin": b"\n" * 1000, "one.bin": b"x" * 5000, "crlf.bin": b"a\r\n\r" * 900,
             "mark.bin": b"\xef\xbb\xbf" + noise, "marked.bin": b"\xef\xbb\xbf" + noise + b"\n", "odd name.bin": b"\n" + noise, "packed.bin.gz": noise[:2000],
             "few.bin": b"small"}
    for name, data in files.items():
        with open(os.path.join(scratch, name), "wb") as out:
            out.write(data)
    through_driver = []
    plain = inventory._driver_digest
    monkeypatch.setattr(inventory, "_driver_digest", lambda s, uri: through_driver.append(uri) or plain(s, uri))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = {r["file_name"]: (r["size_bytes"], r["checksum_sha256"]) for r in inventory.file_inventory(spark, scratch, "*", row_bytes=900).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert got == {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items()}
    assert [uri.rsplit("/", 1)[1] for uri in through_driver] == ["packed.bin.gz"]


def test_no_task_reads_a_large_file_whole(spark, scratch, monkeypatch):
    """a file's digest goes on from task to task, each of which reads a step of it."""
    import random
    rng = random.Random(5)
    noise = rng.randbytes(200_000)
    files = {"noise.bin": noise, "closing.bin": noise[7:] + b"\n", "newlines.bin": b"\n" * 50_000, "one.bin": b"x" * 90_000,
             "runs.bin": b"\n" + b"y" * 33_000 + b"\n" + noise[:20_000] + b"\nz" * 9_000, "mark.bin": b"\xef\xbb\xbf" + noise[3:],
             "marked.bin": b"\xef\xbb\xbf" + b"\n" * 30_000, "odd [1] {a,b}*?.bin": noise[:60_000], "packed [2].bin.gz": noise[:70_000], "few.bin": b"small"}
    for name, data in files.items():
        with open(os.path.join(scratch, name), "wb") as out:
            out.write(data)
    taken = spark.sparkContext.accumulator(0)
    most, feed = 21_000, inventory._feed

    def watched(before, head, rows):
        rows = list(rows)
        size = sum(len(block) * 3 // 4 for _, block in rows)
        taken.add(size > 2 * most and not any(name in rows[0][0] for name in ("one.bin", "runs.bin")))  # no newline to cut at
        return feed(before, head, iter(rows))

    monkeypatch.setattr(inventory, "_feed", watched)
    monkeypatch.setattr(inventory, "_driver_digest", None)
    monkeypatch.setattr(inventory, "_BLOCK_BYTES", 5_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        got = {r["file_name"]: (r["size_bytes"], r["checksum_sha256"]) for r in inventory.file_inventory(spark, scratch, "*", task_bytes=most).collect()}
        monkeypatch.setattr(inventory, "_sha256_calls", lambda: None)
        monkeypatch.setattr(inventory, "_feed", feed)
        unshared = {r["file_name"]: (r["size_bytes"], r["checksum_sha256"]) for r in inventory.file_inventory(spark, scratch, "*", row_bytes=40_000 * 2, task_bytes=most).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert got == unshared == {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items()}
    assert taken.value == 0


def test_a_digest_goes_on_from_its_state():
    first = inventory._Sha256(inventory._sha256_calls())
    data = bytes(range(256)) * 3
    first.update(data[:100])
    second = inventory._Sha256(inventory._sha256_calls(), first.state())
    second.update(data[100:])
    assert second.hexdigest() == second.hexdigest() == hashlib.sha256(data).hexdigest()
    assert first.hexdigest() == hashlib.sha256(data[:100]).hexdigest()


def test_a_file_of_one_step_needs_no_state(monkeypatch):
    import base64
    monkeypatch.setattr(inventory, "_sha256_calls", lambda: None)
    rows = [("u", base64.b64encode(part).decode()) for part in (b"a\nb", b"\nc")]
    [(uri, (fed, state, ends))] = inventory._feed({"u": inventory._left(0, inventory._begun(b"!"))}, b"!", rows)
    assert (uri, fed, state) == ("u", 5, None)
    assert ends == {over: hashlib.sha256(data).hexdigest() for over, data in enumerate((b"!a\nb\nc", b"!a\nb\nc\n"))}
    assert list(inventory._feed({}, b"", [])) == []


def test_row_counts_are_per_file_path(spark, scratch):
    spark.range(1000).withColumn("part", F.col("id") % 4).coalesce(1).write.partitionBy("part").parquet(f"{scratch}/t")
    got = inventory.parquet_row_counts(spark.read.parquet(f"{scratch}/t")).collect()
    assert sorted(r["row_count"] for r in got) == [250] * 4
    assert len({r["file_path"] for r in got}) == 4 and len({r["file_name"] for r in got}) == 1


def test_manifest_round_trip(spark, scratch):
    """Nested manifest JSON -> batch descriptor (first file = source_uri, all = source_uris)."""
    from lakeshore.sources.manifest import manifest_document, manifest_file_rows

    files = manifest_file_rows(spark.read.parquet(f"{SF001}/documents.parquet"))
    manifest_document(files, "2025-01-01T00:00:00+00:00").write.json(os.path.join(scratch, "m"))
    desc = inventory.batch_descriptors(inventory.read_manifests(spark, os.path.join(scratch, "m")), "silver")
    rows = inventory.require_batch(desc)
    assert len(rows) == 1
    r = rows[0]
    assert r["source_uri"] == r["source_uris"][0] and r["source_uri"].startswith("s3a://bronze/nyc-taxi/year=")
    assert len(r["source_uris"]) == files.count()
    assert r["silver_uri"] == "s3a://silver/nyc-taxi/year=scale/month=batch"


def test_batch_descriptor_rejects_other_dataset(spark, scratch):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as fh:
        json.dump({"dataset": "other", "files": [{"bronze_key": "k"}], "year": "2025", "month": "01",
                   "bronze_bucket": "b"}, fh)
    with pytest.raises(ValueError, match="Unsupported dataset"):
        inventory.require_batch(inventory.batch_descriptors(inventory.read_manifests(spark, path), "s"))


def _files(spark, rows):
    return spark.createDataFrame(rows, "bronze_key string, file_name string, size_bytes long, checksum_sha256 string")


def test_ingest_plan_actions_and_conflicts(spark):
    expected = _files(spark, [("k/a", "a", 10, "h1"), ("k/b", "b", 20, "h2"), ("k/c", "c", 30, "h3"),
                              ("k/d", "d", 40, "h4")])
    actual = _files(spark, [("k/b", "b", 20, "h2"), ("k/c", "c", 30, "zz"), ("k/d", "d", 41, "h4")])
    plan = {r["bronze_key"]: r["action"] for r in inventory.ingest_plan(expected, actual).collect()}
    assert plan == {"k/a": "upload", "k/b": "exists", "k/c": "conflict", "k/d": "conflict"}
    forced = {r["bronze_key"]: r["action"] for r in inventory.ingest_plan(expected, actual, force=True).collect()}
    assert forced["k/c"] == forced["k/d"] == "overwrite"
    with pytest.raises(ValueError, match="differ from the manifest: k/c, k/d$"):
        inventory.require_no_conflicts(inventory.ingest_plan(expected, actual))
    inventory.require_no_conflicts(inventory.ingest_plan(expected, actual, force=True))


def test_manifest_equality_ignores_generated_at(spark):
    schema = "file_name string, size_bytes long, generated_at string"
    a = spark.createDataFrame([("a", 1, "2025-01-01"), ("b", 2, "2025-01-01")], schema)
    b = spark.createDataFrame([("b", 2, "2025-02-01"), ("a", 1, "2025-02-01")], schema)
    assert inventory.manifest_differences(a, b).count() == 0
    c = spark.createDataFrame([("a", 1, "x"), ("b", 3, "x")], schema)
    diff = {(r["file_name"], r["side"]) for r in inventory.manifest_differences(a, c).collect()}
    assert diff == {("b", "left"), ("b", "right")}


def test_require_unique_lists_sorted_duplicates(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "name string")
    with pytest.raises(ValueError, match="Duplicate values: a, b$"):
        inventory.require_unique(df, "name")
    many = spark.range(60).selectExpr("concat('k', lpad(id, 2, '0')) AS name")
    with pytest.raises(ValueError) as caught:
        inventory.require_unique(many.union(many), "name")
    assert str(caught.value).endswith(", ".join(f"k{i:02d}" for i in range(60)))
    inventory.require_unique(df.distinct(), "name")


def test_sql_file_set_covers_the_four_views_and_binds_parameters(spark, tmp_path):
    import re
    from lakeshore.plans import SQL_DIR
    from lakeshore.plans.runner import load_sql_queries, referenced_parameters, run_sql
    files = load_sql_queries(SQL_DIR)
    assert [p.name[:2] for p in files] == ["01", "02", "03", "04", "05", "06"]
    text = " ".join(p.read_text() for p in files)
    views = set(re.findall(r"\bFROM\s+(\w+)", text))
    assert views == {"silver_trips", "daily_trip_metrics", "location_metrics", "payment_metrics"}
    assert referenced_parameters("WHERE d BETWEEN :start_date AND :end_date AND x = '::text'") == ["end_date", "start_date"]
    with pytest.raises(ValueError, match="missing parameters pickup_date"):
        run_sql(spark, files[4], {})
    with pytest.raises(ValueError, match="no .sql file"):
        load_sql_queries(tmp_path)


def test_layout_benchmark_rejects_bad_arguments(spark, tmp_path):
    from lakeshore.plans.layouts import benchmark_layouts
    for kwargs in ({"iterations": 0}, {"warmup": -1}, {"comparison": "zorder"},
                   {"comparison": "compaction", "coalesce": 0}, {"coalesce": -1}):
        with pytest.raises(ValueError):
            benchmark_layouts(spark, str(tmp_path / "none"), [], str(tmp_path), **kwargs)


def test_cluster_settings_win_over_session_defaults(spark):
    from lakeshore.session import apply_defaults
    spark.sparkContext.getConf().get("spark.driver.memory")  # set by the test session
    applied = apply_defaults(spark, {"spark.driver.memory": "1g", "spark.sql.shuffle.partitions": "8"})
    assert "spark.driver.memory" not in applied
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_folder_rules():
    from lakeshore.session import ensure_checkpoint_dir

    class _Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class _Ctx:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class _Session:
        def __init__(self, master, configured=None):
            self.conf, self.sparkContext = _Conf(configured), _Ctx(master)

    shared = _Session("spark://cluster:7077", "hdfs://nn/checkpoints")
    assert ensure_checkpoint_dir(shared) == "hdfs://nn/checkpoints" == shared.sparkContext.dir
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"))
    local = _Session("local[8]")
    assert ensure_checkpoint_dir(local).startswith(tempfile.gettempdir())
