"""Landing, payloads, streaming, tables and end-to-end runs."""

import csv
import hashlib
import io
import json
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from registered_queries import Lab, json_array_rows
from shoplens.constants import API_SOURCE, CONTENT_KEY, DELTA_FEED, POPULARITY_KEY
from shoplens.plans import build, expectations, latest, raw_checks, staging
from shoplens.schemas import CATEGORY_TREE_CSV, DELTA_RECORD, EVENTS_CSV, ITEM_PROPERTIES_CSV
from shoplens.session import scratch_root
from shoplens.sinks import landing as sink, reports, tables
from shoplens.sources import external, landing, payloads
from shoplens.sources.blocks import CsvRecords, digests
from shoplens.sources.fixtures import FixtureTables
from shoplens.streaming.delta import append_delta, read_delta_stream
from shoplens.streaming import responses
from shoplens.streaming.latest_state import LatestPropertyState
from shoplens.streaming.responses import ResponseSplit

RECORD = {"timestamp": 1431226800000, "itemid": 46, "property": "categoryid", "value": "1"}
PAGES = {
    "a": {"records": [RECORD], "next_cursor": "c1", "has_more": True},
    "b": {"data": [RECORD, RECORD], "success": True, "count": 2, "total_rows": 9, "unread_rows": 7},
    "last": {"records": [], "next_cursor": None, "has_more": False},
    "count": {"data": [RECORD], "success": True, "count": 2, "total_rows": 9, "unread_rows": 7},
    "fail": {"data": [], "success": False, "count": 0, "total_rows": 0, "unread_rows": 0},
    "none": {"other": 1},
    "nolist": {"data": {"x": 1}, "success": True, "count": 0},
    "nocursor": {"records": [], "has_more": False},
    "nomore": {"records": [], "next_cursor": None},
}


def _pages(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        with open(f"{folder}/{name}.json", "w") as file:
            json.dump(PAGES[name], file, indent=2)
    return str(folder)


def test_payload_contracts(spark, tmp_path):
    folder = _pages(tmp_path / "p", *PAGES)
    parsed = payloads.parse_payloads(payloads.read_payload_text(spark, folder))
    got = {os.path.basename(r.raw_response_file)[:-5]: r for r in parsed.collect()}
    assert {name for name, r in got.items() if r.problem is None} == {"a", "b", "last"}
    assert got["a"].api_contract == payloads.RECORDS_CONTRACT and got["a"].next_cursor == "c1" and got["a"].has_more
    assert got["b"].api_contract == payloads.DATA_CONTRACT and got["b"].api_count == 2 and got["b"].unread_rows == 7
    assert got["count"].problem.startswith("count differs") and got["fail"].problem == "success is false"
    assert got["none"].problem == "neither data nor records" and got["nolist"].problem == "data is not a list"
    assert got["nocursor"].problem == "next_cursor is missing" and got["nomore"].problem == "has_more is missing"
    records = payloads.normalise_records(parsed, "20260101_000000")
    assert records.count() == 3 and records.columns == DELTA_RECORD.fieldNames()
    with pytest.raises(ValueError):
        payloads.require_valid(parsed)


def test_empty_page_keeps_the_schema(spark, tmp_path):
    parsed = payloads.parse_payloads(payloads.read_payload_text(spark, _pages(tmp_path / "p", "last")))
    records = payloads.normalise_records(parsed, "s")
    assert records.count() == 0 and [f.dataType for f in records.schema] == [f.dataType for f in DELTA_RECORD]


def test_land_payloads_and_check_them(spark, tmp_path):
    root = str(tmp_path / "raw")
    sink.land_payloads(spark, _pages(tmp_path / "p1", "a"), root, "20260101_000000")
    manifest = sink.land_payloads(spark, _pages(tmp_path / "p2", "b"), root, "20260101_003000")
    assert sorted(r["format"] for r in manifest.collect()) == ["csv", "json", "parquet", "parquet"]
    report = raw_checks.delta_report(spark, root).collect()
    assert {r.status for r in report} == {"PASS"}, [r for r in report if r.status != "PASS"]
    names = {r.check_name for r in report}
    assert {"raw_response_contract", "parquet_exists", "raw_response_exists", "state_cursor", "normalized_parquet_row_count"} <= names
    state = sink.ingest_state(landing.read_manifest(spark, root)).first()
    assert (state.cursor, state.records_ingested_total, state.last_api_unread_rows) == ("c1", 3, 7)
    with pytest.raises(FileExistsError):
        sink.land_payloads(spark, _pages(tmp_path / "p3", "a"), root, "20260101_000000")
    with pytest.raises(ValueError):
        sink.land_payloads(spark, _pages(tmp_path / "p4", "fail"), root, "20260101_010000")
    assert landing.read_manifest(spark, root).count() == 8


def test_tampered_partition_fails_the_checks(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([(1, 2, "p", "v", API_SOURCE, "20260101_000000")], DELTA_RECORD)
    sink.land(rows, root, DELTA_FEED, "20260101_000000", API_SOURCE)
    rows.write.mode("append").parquet(landing.partition_path(root, DELTA_FEED, "parquet", "20260101_000000"))
    report = raw_checks.delta_report(spark, root, expected_formats=("parquet", "csv"), with_responses=False)
    bad = {r.check_name for r in expectations.problems(report, "FAIL").collect()}
    assert bad == {"csv_exists", "normalized_parquet_row_count", "checksum_matches_metadata"}


def test_preferred_format_latest_and_missing(spark, tmp_path, rows):
    root = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        landing.read_latest(spark, root, DELTA_FEED, "csv", DELTA_RECORD)
    with pytest.raises(FileNotFoundError):
        landing.read_manifest(spark, root, required=True)

    def one(stamp, value, formats):
        df = spark.createDataFrame([(1, 2, "p", value, API_SOURCE, stamp)], DELTA_RECORD)
        sink.land(df, root, DELTA_FEED, stamp, API_SOURCE, formats)

    one("20260101_000000", "old", ("json",))
    one("20260102_000000", "mid", ("csv", "json"))
    one("20260103_000000", "new", ("json", "csv", "parquet"))
    choice = landing.preferred_formats(landing.read_manifest(spark, root), DELTA_FEED)
    assert rows(choice, "ingestion_timestamp", "format") == [
        ("20260101_000000", "json"), ("20260102_000000", "csv"), ("20260103_000000", "parquet"),
    ]
    assert [r[0] for r in rows(landing.read_preferred(spark, root, DELTA_FEED), "value")] == ["mid", "new", "old"]
    assert rows(landing.read_latest(spark, root, DELTA_FEED, "json", DELTA_RECORD), "value") == [("new",)]


def test_batch_landing_and_its_report(spark, tmp_path):
    source = tmp_path / "events.csv"
    source.write_text("timestamp,visitorid,event,itemid,transactionid\n1,2,view,3,\n4,5,transaction,6,7\n")
    root = str(tmp_path / "raw")
    manifest = sink.land_batch(spark, str(source), root, "events", "20260101_000000", EVENTS_CSV.fieldNames())
    assert manifest.first().row_count == 2 and manifest.first().file_bytes > 0
    sink.write_sidecar(manifest, root)
    assert landing.read_sidecars(spark, root).first().row_count == 2
    report = raw_checks.batch_report(spark, root, ["events", "category_tree"]).collect()
    assert {(r.dataset_name, r.status) for r in report} == {("raw_batch_events", "PASS"), ("raw_batch_category_tree", "FAIL")}
    landed = landing.read_latest(spark, root, "events", "csv", EVENTS_CSV)
    staged = staging.stage_events(landed, staging.file_of_row())
    assert {(r.transaction_id, r.event_type) for r in staged.collect()} == {(None, "view"), (7, "transaction")}
    assert "ingestion_timestamp=20260101_000000" in staged.first()["_source_file"]
    sums = digests(spark, str(tmp_path), "events.csv").collect()
    wanted = hashlib.sha256(source.read_bytes()).hexdigest()
    assert {r.checksum_sha256 for r in sums} == {wanted} == {manifest.first().checksum_sha256}


def test_csv_and_json_sources(spark, tmp_path):
    (tmp_path / "tree.csv").write_text("categoryid,parentid\n1016,213\n231,\n")
    tree = staging.stage_category_tree(external.read_category_tree(spark, str(tmp_path / "tree.csv")))
    assert {(r.category_id, r.parent_category_id, r.is_root_category) for r in tree.collect()} == {(1016, 213, 0), (231, None, 1)}
    (tmp_path / "props.csv").write_text("timestamp,itemid,property,value\n1,2,790,n26.400 1135780\n")
    assert external.read_item_properties(spark, str(tmp_path / "props.csv")).first().value == "n26.400 1135780"
    (tmp_path / "delta.json").write_text(json.dumps([RECORD, RECORD], indent=2))
    assert external.read_json_array(spark, str(tmp_path / "delta.json"), ITEM_PROPERTIES_CSV).count() == 2
    assert CATEGORY_TREE_CSV.fieldNames() == ["categoryid", "parentid"]


def _api_rows(spark, small):
    props = FixtureTables(spark, small).item_properties()
    return props, props.where(F.col("source_system") == API_SOURCE)


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (3, 0, 4, 2, 1)])
def test_streamed_state_equals_batch_in_any_file_order(spark, small, tmp_path, rows, order):
    """Each file comes in a run of its own, which goes on from the checkpoint of the last one."""
    _, api = _api_rows(spark, small)
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    with pytest.raises(FileNotFoundError):
        LatestPropertyState(spark, root).current()
    schema = api.withColumn("ingestion_timestamp", F.lit("")).schema
    seed = staging.stage_properties_delta(api.where(F.col("seq") % 5 == order[0]).withColumn("ingestion_timestamp", F.lit("seed")))
    LatestPropertyState(spark, root).seed(seed)
    for part in order[1:]:
        api.where(F.col("seq") % 5 == part).withColumn("ingestion_timestamp", F.lit(f"run{part}")).coalesce(1).write.mode("append").parquet(source)
        state = LatestPropertyState(spark, root)  # as after a restart
        state.absorb(read_delta_stream(spark, source, schema)).awaitTermination()
    with pytest.raises(FileExistsError):
        state.seed(seed)
    expected = staging.stage_properties_delta(api)
    columns = ["item_id", "category_id", "category_timestamp_ms"]
    assert rows(latest.item_category_latest(state.current()), *columns) == rows(latest.item_category_latest(expected), *columns)
    columns = ["item_id", "is_available", "availability_timestamp_ms"]
    assert rows(latest.item_availability_latest(state.current()), *columns) == rows(latest.item_availability_latest(expected), *columns)


def test_state_does_not_grow_with_the_batches(spark, small, tmp_path):
    _, api = _api_rows(spark, small)
    source = str(tmp_path / "in")
    part = api.withColumn("ingestion_timestamp", F.lit("r")).where(F.col("seq") % 40 == 0)
    for _ in range(12):
        part.coalesce(1).write.mode("append").parquet(source)
    state = LatestPropertyState(spark, str(tmp_path / "state"))
    query = state.absorb(read_delta_stream(spark, source, part.schema, files_per_batch=1))
    query.awaitTermination()
    totals = [progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress]
    assert len(totals) >= 12 and len(set(totals)) == 1
    assert state.current().count() == totals[0] == state.newest(staging.stage_properties_delta(part)).count()


def test_responses_are_split_once_across_restarts(spark, tmp_path, monkeypatch):
    """A batch that fails between its two tables is written again under its name; no page is taken twice."""
    root, bodies = str(tmp_path / "raw"), {name: json.dumps(page) for name, page in PAGES.items()}

    def land(stamp, *names):
        rows = spark.createDataFrame([(bodies[name], stamp) for name in names], "value string, ingestion_timestamp string")
        sink.land_partitions(rows, root, landing.response_type(DELTA_FEED), API_SOURCE)

    split = ResponseSplit(spark, str(tmp_path / "split"))
    with pytest.raises(FileNotFoundError):
        split.read("records")
    land("20260101_000000", "a", "b", "count", "none")
    broken = ResponseSplit(spark, split.target)
    monkeypatch.setattr(responses, "normalise_records", lambda pages, stamp: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        broken.absorb(root, DELTA_FEED).awaitTermination()
    monkeypatch.undo()
    for stamp, names in (("20260102_000000", ("fail", "last")), ("20260103_000000", ("b", "nomore"))):
        split.absorb(root, DELTA_FEED).awaitTermination()
        land(stamp, *names)
    split.absorb(root, DELTA_FEED).awaitTermination()
    split.absorb(root, DELTA_FEED).awaitTermination()
    assert split.read("records").count() == 3 + 2
    got = sorted((r.ingestion_timestamp[:8], r.problem) for r in split.read("rejected").collect())
    assert got == [("20260101", "count differs from the number of records"), ("20260101", "neither data nor records"),
                   ("20260102", "success is false"), ("20260103", "has_more is missing")]


def test_appended_delta_keeps_duplicates_and_takes_files_once(spark, small, tmp_path):
    _, api = _api_rows(spark, small)
    rows_in = api.withColumn("ingestion_timestamp", F.lit("r"))
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "ckpt"))
    for expected in (1, 2):
        rows_in.write.mode("append").parquet(source)
        append_delta(read_delta_stream(spark, source, rows_in.schema), target, checkpoint).awaitTermination()
        append_delta(read_delta_stream(spark, source, rows_in.schema), target, checkpoint).awaitTermination()
        assert spark.read.parquet(target).count() == expected * rows_in.count()


def test_catalog_tables_views_and_inventory(spark):
    tables.reset_layers(spark, ("staged", "mart"))
    df = spark.range(10).withColumn("user_id", F.col("id") % 3)
    tables.save_table(df, "staged", "events", bucket_by="user_id", buckets=4)
    tables.create_view(spark, "mart", "interactions", "staged.events")
    got = {r.relation_name: r for r in tables.table_inventory(spark, [("staged", "events"), ("mart", "interactions"), ("mart", "gone")]).collect()}
    assert (got["events"].relation_type, got["events"].row_count, got["events"].status) == ("BASE TABLE", 10, "PASS")
    assert (got["interactions"].relation_type, got["interactions"].column_count) == ("VIEW", 2)
    assert (got["gone"].relation_type, got["gone"].status) == ("MISSING", "FAIL")
    names = [(r.schema_name, r.table_name, r.column_name) for r in tables.catalog_schema_summary(spark, ("staged", "mart")).collect()]
    assert names == [("mart", "interactions", "id"), ("mart", "interactions", "user_id"), ("staged", "events", "id"), ("staged", "events", "user_id")]
    plan = spark.table("staged.events").groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    tables.reset_layers(spark, ("staged", "mart"))


def test_reports_are_merged_by_model(spark, tmp_path, rows):
    path = str(tmp_path / "report")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "model_key string, n int")
    reports.merge_csv_report(first, path, "a")
    merged = reports.merge_csv_report(spark.createDataFrame([("a", 5)], "model_key string, n int"), path, "a")
    assert rows(merged) == [("a", "5"), ("b", "2")]
    table = str(tmp_path / "table")
    reports.write_model_report(first, table)
    reports.write_model_report(spark.createDataFrame([("a", 7)], "model_key string, n int"), table)
    assert rows(reports.read_model_report(spark, table), "model_key", "n") == [("a", 7), ("b", 2)]


def test_scratch_folder_follows_the_session(spark):
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_root(spark).startswith((configured or warehouse).rstrip("/"))
    assert context.getCheckpointDir() == configured or configured  # the caller's folder stays as it is


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("visitorid,timestamp,extra,event,itemid,transactionid\n7,1000,x,view,3,\n")
    row = external.read_events(spark, str(path)).first()
    assert (row.timestamp, row.visitorid, row.event, row.itemid, row.transactionid) == (1000, 7, "view", 3, None)
    path.write_text("visitorid,event,itemid,transactionid\n7,view,3,\n")
    with pytest.raises(ValueError, match="timestamp"):
        external.read_events(spark, str(path))


def test_landed_batch_keeps_all_columns_line_breaks_and_empty_texts(spark, tmp_path):
    path = tmp_path / "props.csv"
    path.write_text('itemid,property,value,note\n1,a,"two\nlines",x\n2,b,"",\n3,c,,"say ""hi"""\n')
    root = str(tmp_path / "landing")
    manifest = sink.land_batch(spark, str(path), root, "props", "20260101_000000", ["itemid", "property", "value"])
    assert manifest.first().row_count == 3
    landed = spark.read.options(**landing.CSV_READ).csv(
        f"{root}/type=props/format=csv/ingestion_timestamp=20260101_000000")
    assert sorted(tuple(r) for r in landed.select("itemid", "value", "note").collect()) == sorted(
        [("1", "two\nlines", "x"), ("2", "", None), ("3", None, 'say "hi"')], key=repr)


def test_records_are_those_of_a_csv_reader():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["a", ",", '"', '""', "\n", "\r\n", "\r", "é"]) for _ in range(rng.randrange(14)))
        body, at, records = text.encode(), 0, CsvRecords()
        while at < len(body):
            size = rng.randrange(1, 6)
            records.add(np.frombuffer(body[at: at + size], np.uint8))
            at += size
        assert records.total() == sum(1 for _ in csv.reader(io.StringIO(text, newline=""))), repr(text)


def _csv_folder(folder, files=3):
    os.makedirs(folder)
    for k in range(files):
        lines = "".join(f'{k},{n},"a ""quoted""\nline",\r\n' for n in range(200))
        (folder / f"part {k}.csv").write_text(f"itemid,n,value,note\n{lines}")
    return folder


def test_marks_of_a_block_are_few_python_objects_at_a_time():
    import tracemalloc

    body = np.frombuffer(b'"a","b"\n' * 100_000, np.uint8)
    tracemalloc.start()
    records = CsvRecords()
    records.add(body)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert records.total() == 100_000 and peak < 16e6


def test_digests_without_records_are_the_same_digests(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": "1,2"}\n' * 1000)
    known, plain = digests(spark, str(tmp_path)).first(), digests(spark, str(tmp_path), with_records=False).first()
    assert (known.checksum_sha256, known.file_bytes) == (plain.checksum_sha256, plain.file_bytes) and plain.records is None


def test_json_arrays_are_no_file_per_few_rows(spark, small):
    lab = Lab(spark, small)
    found = json_array_rows(lab)
    assert len(found.inputFiles()) <= 2 < found.count()


def test_digests_do_not_depend_on_the_block(spark, tmp_path):
    folder = _csv_folder(tmp_path / "csv")
    whole = digests(spark, str(folder)).select("name", "file_bytes", "checksum_sha256", "records").collect()
    parts = digests(spark, str(folder), block_bytes=7).select("name", "file_bytes", "checksum_sha256", "records").collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 3
    for row in whole:
        body = (folder / row.name).read_bytes()
        assert (row.file_bytes, row.checksum_sha256, row.records) == (len(body), hashlib.sha256(body).hexdigest(), 201)


def test_landed_files_equal_the_source_bytes(spark, tmp_path):
    folder, root = _csv_folder(tmp_path / "csv"), str(tmp_path / "raw")
    row = sink.land_batch(spark, str(folder), root, "props", "20260101_000000", ["itemid", "value"]).first()
    assert (row.file_count, row.row_count) == (3, 600)
    for name in os.listdir(folder):
        assert (folder / name).read_bytes() == open(f"{row.landing_path}/{name}", "rb").read()
    assert {r.status for r in raw_checks.batch_report(spark, root, ["props"]).collect()} == {"PASS"}
    with pytest.raises(FileExistsError):
        sink.land_batch(spark, str(folder), root, "props", "20260101_000000", ["itemid"])
    with open(f"{row.landing_path}/part 1.csv", "ab") as file:
        file.write(b"x")
    bad = {r.check_name for r in raw_checks.batch_report(spark, root, ["props"]).collect() if r.status == "FAIL"}
    assert bad == {"row_count_matches_metadata", "checksum_matches_metadata"}
    assert [r.presence for r in landing.presence(spark, root).collect()] == ["incomplete"]


def test_a_failure_before_the_manifest_row_is_taken_over(spark, tmp_path, monkeypatch):
    folder, root = _csv_folder(tmp_path / "csv"), str(tmp_path / "raw")
    stamp, append = "20260101_000000", sink.append_manifest
    rows = spark.createDataFrame([(1, 2, "p", "v", API_SOURCE, stamp)], DELTA_RECORD)

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(sink, "append_manifest", fail)
    for landing_of in (lambda: sink.land_batch(spark, str(folder), root, "props", stamp, ["itemid"]),
                       lambda: sink.land(rows, root, DELTA_FEED, stamp, API_SOURCE, ("parquet", "json"))):
        with pytest.raises(OSError, match="lost"):
            landing_of()
    assert {r.presence for r in landing.presence(spark, root).collect()} == {"unlisted"}
    monkeypatch.setattr(sink, "append_manifest", append)
    path = landing.partition_path(root, "props", "csv", stamp)
    before = os.stat(f"{path}/part 1.csv").st_mtime_ns
    adopted = sink.land_batch(spark, str(folder), root, "props", stamp, ["itemid"]).first()
    assert os.stat(f"{path}/part 1.csv").st_mtime_ns == before and adopted.row_count == 600
    sink.land(rows, root, DELTA_FEED, stamp, API_SOURCE, ("parquet", "json"))
    assert {r.presence for r in landing.presence(spark, root).collect()} == {"present"}
    assert {r.status for r in raw_checks.batch_report(spark, root, ["props"]).collect()} == {"PASS"}
    # leftovers of other files are replaced
    with pytest.raises(OSError):
        monkeypatch.setattr(sink, "append_manifest", fail)
        sink.land_batch(spark, str(folder), root, "props", "20260102_000000", ["itemid"])
    monkeypatch.setattr(sink, "append_manifest", append)
    (folder / "part 0.csv").write_text("itemid,n\n1,2\n")
    (folder / "part 1.csv").write_text("itemid,n\n3,4\n")
    (folder / "part 2.csv").write_text("itemid,n\n")
    assert sink.land_batch(spark, str(folder), root, "props", "20260102_000000", ["itemid"]).first().row_count == 2


def test_lost_and_unlisted_partitions_both_show(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([(n, 2, "p", "v", API_SOURCE, f"2026010{n}_000000") for n in (1, 2, 3)], DELTA_RECORD)
    manifest = sink.land_partitions(rows, root, DELTA_FEED, API_SOURCE, ("parquet", "csv"))
    assert manifest.count() == 6 and {r.row_count for r in manifest.collect()} == {1}
    shutil.rmtree(landing.partition_path(root, DELTA_FEED, "csv", "20260102_000000"))
    shutil.copytree(landing.partition_path(root, DELTA_FEED, "csv", "20260103_000000"),
                    landing.partition_path(root, DELTA_FEED, "csv", "20260109_000000"))
    got = {(r.format, r.ingestion_timestamp): r.presence for r in landing.presence(spark, root).collect()}
    assert got.pop(("csv", "20260102_000000")) == "missing" and got.pop(("csv", "20260109_000000")) == "unlisted"
    assert set(got.values()) == {"present"} and len(got) == 5
    bad = {(r.dataset_name[-15:], r.check_name) for r in raw_checks.presence_report(spark, root).collect() if r.status == "FAIL"}
    assert bad == {("20260102_000000", "csv_presence"), ("20260109_000000", "csv_presence")}


def test_newest_partition_in_a_format_is_read(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = spark.createDataFrame([(1, "a")], "n bigint, t string")
    sink.land(rows, root, "mixed", "20260101_000000", "s", ("parquet", "csv"), "f")
    sink.land(rows.limit(0).union(rows).union(rows), root, "mixed", "20260102_000000", "s", ("csv",), "f")
    assert landing.read_latest(spark, root, "mixed", "parquet", rows.schema).count() == 1
    assert landing.read_latest(spark, root, "mixed", "csv", rows.schema).count() == 2
    with pytest.raises(FileNotFoundError):
        landing.read_latest(spark, root, "mixed", "json", rows.schema)


def _rows_scanned(df):
    """Rows that the scan gave, which are those of the row groups it read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_a_key_is_found_in_few_row_groups(spark, tmp_path):
    rng = random.Random(2)
    pairs = [(user, rng.randrange(10 ** 9), rng.random()) for user in range(4000) for _ in range(10)]
    frame = spark.createDataFrame(pairs, "user_id bigint, item_id bigint, weight double").orderBy(F.rand(1))
    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    frame.write.option("parquet.block.size", 32 << 10).parquet(plain)
    tables.write_keyed(frame, keyed, ["user_id", "item_id"], row_group_bytes=32 << 10)
    user, item, weight = pairs[777]
    read = {}
    for name, condition in (("first", f"user_id = {user}"), ("second", f"item_id = {item}"), ("both", f"user_id = {user} and item_id = {item}"),
                            ("none", "item_id = -5")):
        for path in (plain, keyed):
            found = spark.read.parquet(path).where(condition)
            assert {r.weight for r in found.collect()} == {w for u, i, w in pairs if eval(condition.replace(" = ", " == "), {"user_id": u, "item_id": i})}
            read[name, path] = _rows_scanned(spark.read.parquet(path).where(condition))
    assert read["first", keyed] * 5 < read["first", plain] and read["both", keyed] * 5 < read["both", plain]
    assert read["second", keyed] * 5 < read["second", plain] and read["none", keyed] * 5 < len(pairs)


def test_an_unreadable_dataset_fails_and_the_report_goes_on(spark, small, tmp_path):
    """One by its schema, one by a file in its midst."""
    props, api = _api_rows(spark, small)
    store = tables.LayerStore(spark, str(tmp_path / "store"))
    fixtures = FixtureTables(spark, small)
    build.build(store, build.RawInputs(
        fixtures.order_events(), fixtures.category_tree(), props.where(F.col("source_system") != API_SOURCE), api))
    for layer, name in (("staged", "category_tree"), ("staged", "item_availability_latest")):
        folder = store.path(layer, name)
        files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
        shutil.copy(f"{folder}/{files[0]}", f"{folder}/part-99999-whole.parquet")
        broken = files if name == "category_tree" else files[-1:]
        for file in [*broken, *(["part-99999-whole.parquet"] if name == "category_tree" else [])]:
            open(f"{folder}/{file}", "wb").write(b"no parquet")
        for file in os.listdir(folder):
            if file.endswith(".crc"):
                os.remove(f"{folder}/{file}")
    report = build.validate(store, strict=False).collect()
    failed = {(r.dataset_name, r.check_name) for r in report if r.status == "FAIL"}
    assert failed == {("category_tree", "read_parquet"), ("item_availability_latest", "read_parquet"), ("referential_coverage", "file_exists")}
    assert {r.status for r in report if r.dataset_name == "events"} == {"PASS"} or len(report) > 40
    with pytest.raises(RuntimeError):
        build.validate(store)


def test_end_to_end_run(spark, small, tmp_path):
    fixtures = FixtureTables(spark, small)
    props, api = _api_rows(spark, small)
    store = tables.LayerStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError, match="build"):
        build.train(store, POPULARITY_KEY)
    raw = build.RawInputs(
        fixtures.order_events(), fixtures.category_tree(), props.where(F.col("source_system") != API_SOURCE), api
    )
    build.build(store, raw)
    report = build.validate(store)
    assert report.where("status = 'FAIL'").count() == 0 and report.count() == 62
    with pytest.raises(FileNotFoundError, match="train"):
        build.recommend(store, CONTENT_KEY)
    for key in (POPULARITY_KEY, CONTENT_KEY):
        build.train(store, key, test_days=180)
        for _ in range(2):
            recommended, summary = build.recommend(store, key)
        assert recommended.count() == 25 and summary.first().recommendation_rows == 25
    assert spark.read.parquet(store.path("reports", "recommendations")).count() == 50
    assert build.compare(store).count() == 2
    summary, documentation, retrieval = build.describe_features(store)
    assert [r.row_count == r.distinct_keys for r in summary.collect()] == [True] * 3
    assert documentation.count() == 16 + 21 + 24
    assert {r.rows_returned for r in retrieval.collect()} == {1}
    assert set(json.loads(retrieval.first().sample_values_json)) >= {"user_id", "total_events"}
    got = {r.relation_name: r.status for r in build.inventory(store, [("staged", "events"), ("mart", "gone")]).collect()}
    assert got == {"events": "PASS", "gone": "FAIL"}

    events = store.load("staged", "events")
    assert store.load("curated", "curated_interactions").count() == events.count()
    assert store.load("features", "user_features").count() == events.select("visitor_id").distinct().count()
    assert store.load("features", "item_features").count() == events.select("item_id").distinct().count()
