"""Snapshots, marts, event-window outputs, quality artefacts, archive packs and handoff reports on disk."""

import datetime as dt
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom.operators import event_windows as ew
from tickloom.operators import inventory, normalize, ordered, quality, records, rollup, shards
from tickloom.plans import composites
from tickloom.schemas import BAR, DIVIDEND
from tickloom.sources import files, footers, listing, manifests, packs, tables, versions

ROWS = [
    {"corporate_action_id": f"ca-{i}", "symbol": s, "corporate_action_type": "cash_dividend", "source": "api", "process_date": None, "declaration_date": None, "ex_date": d, "record_date": None, "payable_date": None,
     "cash_amount": 0.2, "stock_amount": None, "currency": "USD", "source_payload_hash": h, "raw": {"_response_key": "cash_dividends", "b": 1, "a": "é"}}
    for i, s, d, h in ((1, "AAPL", "2025-01-10", "a"), (1, "AAPL", "2025-01-10", "b"), (2, "MSFT", "2024-02-09", "c"))
]


@pytest.fixture
def dividends(spark):
    return records.dividend_frame(spark, ROWS)


@pytest.fixture
def bars(spark):
    rows = [("AAPL", f"2025-01-{d:02d}", 10.0 + d) for d in range(6, 15)] + [("MSFT", "2024-02-09", 5.0), (None, "2025-01-06", 1.0)]
    return spark.createDataFrame(rows, "symbol string, day string, open double").selectExpr(
        "symbol", "'1D' AS timeframe", "'t' AS source", "to_timestamp(day) AS ts_utc", "open", "open + 1 AS high", "open - 1 AS low", "open AS close", "CAST(5 AS BIGINT) AS volume", "year(to_date(day)) AS year", "day AS date"
    )


def test_records(spark, dividends):
    assert dividends.columns == DIVIDEND.names and dividends.count() == 3
    assert dividends.first().raw == '{"_response_key":"cash_dividends","a":"é","b":1}'
    assert records.dividend_frame(spark, dividends.withColumn("more", F.lit(1))).columns == DIVIDEND.names and records.dividend_frame(spark, []).count() == 0
    with pytest.raises(ValueError, match="ex_date"):
        records.dividend_frame(spark, [{k: v for k, v in ROWS[0].items() if k != "ex_date"}])


def test_snapshot_to_mart_to_windows(spark, dividends, bars, tmp_path):
    bars = bars.where("symbol IS NOT NULL")
    snap, mart, out = (str(tmp_path / x) for x in ("snap", "mart", "out"))
    meta = tables.write_snapshot(dividends, snap, "2024-01-01", "2025-12-31")
    assert (meta["input_record_count"], meta["written_record_count"], meta["duplicate_record_count"], meta["sources"], meta["source"]) == (3, 2, 1, ["api"], "api")
    assert (meta["nested_cash_dividend_count"], meta["nested_stock_dividend_count"], meta["currency_missing_for_cash_dividend_count"]) == (2, 0, 2) and files.read_json(f"{snap}/_dataset.json") == json.loads(json.dumps(meta))
    made = tables.mart_from_snapshot(spark, snap, mart)
    assert (made["row_count"], made["symbols"], made["years"], made["ingest_start_date"]) == (2, ["AAPL", "MSFT"], [2024, 2025], "2024-01-01")
    found = tables.validate_mart(spark, mart)
    assert found["valid"] and found["symbol_count"] == 2
    files.write_json(made | {"row_count": 9, "event_anchor": "x"}, f"{mart}/_dataset.json")
    assert len(tables.validate_mart(spark, mart)["errors"]) == 2
    assert not tables.validate_mart(spark, str(tmp_path / "none"))["valid"]
    (tmp_path / "mart" / "_dataset.json").write_text("[")
    assert "no JSON" in tables.validate_mart(spark, mart)["errors"][0]
    for got in (tables.snapshot_windows(spark, snap, bars, 1, 1), tables.mart_windows(spark, mart, bars, 1, 1)):
        assert got.count() == 4
    said = tables.write_event_windows(tables.snapshot_windows(spark, snap, bars, 1, 1), out, 1, 1, snap)
    assert said["row_count"] == 4 and files.read_json(f"{out}/_dataset.json")["schema_fields"] == list(ew.OUTPUT)
    assert [r.event_day_offset for r in tables.read_event_windows(spark, out).collect()] == [-1, 0, 1, 0]
    for bad in (lambda: tables.write_event_windows(bars, f"{snap}/x", 1, 1, snap), lambda: tables.write_event_windows(bars, str(tmp_path / "curated"), 1, 1), lambda: tables.write_event_windows(bars, out, 1, 1, anchor="record_date")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(FileNotFoundError):
        tables.read_event_windows(spark, str(tmp_path / "nowhere"))
    for kind, path in (("contract", "run1"), ("csv", "run2.csv"), ("parquet", "run3.parquet")):
        assert composites.run_event_windows(spark, bars, str(tmp_path / path), snapshot=snap, pre=1, post=1, kind=kind)["rows"] == 4
    with pytest.raises(ValueError):
        composites.run_event_windows(spark, bars, out)


def test_partitions_of_a_table(spark, bars, tmp_path):
    tables.write_bars(bars.where("symbol IS NOT NULL"), str(tmp_path / "bars"))
    own = tables.read_partition(spark, str(tmp_path / "bars"), BAR, symbol="AAPL", date="2025-01-07")
    assert own.count() == 1 and "PartitionFilters: [isnotnull(symbol" in own._jdf.queryExecution().toString()
    tables.write_table(bars.limit(1), str(tmp_path / "x.csv"))
    with pytest.raises(ValueError):
        tables.write_table(bars, str(tmp_path / "x.json"))


def test_quality_artefacts(spark, bars, tmp_path):
    broken = bars.unionByName(bars.where("date = '2025-01-06'")).unionByName(bars.where("date = '2025-01-07'").withColumn("high", F.lit(0.0)))
    out = str(tmp_path / "report")
    r = composites.qa_report(broken, out, "1D", strict=True, now="now")
    assert r.exit_code == 1 and set(r.written) == {"qa_summary", "qa_gaps_daily", "qa_duplicates", "qa_ohlc_violations", "qa_ohlc_violations_samples"} and r.reasons[0] == "duplicate_keys=3"
    rows = {x.symbol: x for x in spark.read.option("header", True).csv(f"{out}/qa_summary").collect()}
    assert (rows["AAPL"].row_count, rows["AAPL"].duplicate_keys, rows["AAPL"].ohlc_violation_count, rows["AAPL"].last_updated) == ("11", "2", "2", "now") and rows[None].duplicate_keys == "0"
    assert composites.qa_report(bars.drop("volume").where("symbol = 'MSFT'"), str(tmp_path / "r2"), "1D", strict=True).reasons[-1] == "missing_canonical_columns"
    assert composites.qa_report(None, str(tmp_path / "r3")).exit_code == 0
    e = composites.Export("bars_daily", "1D", "2025-01-06", "2025-01-15", "WEEKDAY", ("AAPL", "ZZZ"))
    run, status = composites.write_export(broken, e, str(tmp_path / "qa"))
    by_symbol, total = composites.read_metrics(spark, run)
    row = by_symbol.where("symbol = 'AAPL'").first()
    assert status == "FAIL" and (row.expected_bars, row.rows_observed, row.gap_count, row.run_id) == (7, 11, 0, e.run_id) and by_symbol.columns == list(composites.BY_SYMBOL)
    assert total.first().symbols_missing == "ZZZ" and total.first().symbols_present == 1
    verdict = composites.enforce_artifacts(spark, run, rollup.Gates(allow_missing_symbols=False))
    assert verdict.reasons == ["duplicate_keys=3 > 0", "ohlc_violations=3 > 0", "missing_symbols=ZZZ"] and "FAIL" in composites.verdict_text(verdict, "QA", True)
    with pytest.raises(SystemExit):
        composites.enforce_or_exit(verdict, True)
    with pytest.raises(FileNotFoundError):
        composites.read_metrics(spark, str(tmp_path))
    tables.write_bars(bars.where("symbol IS NOT NULL"), str(tmp_path / "lake" / "bars_daily"))
    report = composites.handoff_report(spark, str(tmp_path / "lake"), str(tmp_path / "qa"), row_counts=True)
    assert report["available_datasets"] == ["bars_daily"] and report["datasets"]["bars_daily"]["row_count"] == 10 and report["symbols"] == ["AAPL", "MSFT"]
    assert (report["date_min"], report["date_max"], report["qa"]["status"], report["qa"]["latest_run_id"]) == ("2024-02-09", "2025-01-14", "failed", e.run_id)
    assert composites.handoff_report(spark, str(tmp_path / "lake"))["qa"]["status"] == "unknown"
    ready = {r.dataset: (r.file_count, r.ready) for r in files.readiness(spark, str(tmp_path / "lake")).collect()}
    assert ready["bars_1m"] == (0, False) and ready["bars_daily"][1]


def test_reports_read_bars_once(spark, bars, tmp_path):
    """Every row of the source is counted when it is read; just a report's samples read some days again."""
    read = spark.sparkContext.accumulator(0)
    n, schema = bars.count(), bars.schema

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    def told(f):
        before = read.value
        f()
        return read.value - before

    source = bars.mapInArrow(counted, schema)
    clean = source.where("open > 0 AND high >= greatest(open, close) AND low <= least(open, close) AND volume >= 0 AND symbol IS NOT NULL")
    assert told(lambda: composites.qa_report(clean.dropDuplicates(["symbol", "ts_utc", "timeframe"]), str(tmp_path / "r"))) == n
    for e in (composites.Export("bars_daily", "1D", "2025-01-06", "2025-01-15", "WEEKDAY"), composites.Export("bars_1m", "1Min", None, None, "XNYS")):
        assert told(lambda e=e: composites.write_export(source, e, str(tmp_path / e.dataset))) == n
    broken = source.withColumn("high", F.lit(-1.0))
    assert told(lambda: composites.qa_report(broken, str(tmp_path / "b"))) == 2 * n
    got = spark.read.option("header", True).csv(str(tmp_path / "b/qa_ohlc_violations_samples"))
    assert got.groupBy("rule").count().where("count > 50").isEmpty() and got.where("rule = 'nonpositive_price'").count() == n


def test_summary_of_null_symbols(spark, bars):
    got = {r.symbol: r for r in rollup.qa_by_symbol(bars.withColumn("ts_utc", F.when(F.col("symbol").isNotNull(), F.col("ts_utc"))), 10).collect()}
    assert (got[None].rows_observed, got[None].gap_count, got[None].first_ts) == (1, 0, None) and got["AAPL"].rows_observed == 9


def test_order_checks_against_a_loop(spark):
    rng = random.Random(4)
    rows = [("AB"[rng.random() < 0.9], rng.choice(["x", "y"]), rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "symbol string, timeframe string, s long, place long").withColumn("ts_utc", F.timestamp_seconds("s")).repartition(5)
    last, want = {}, dict.fromkeys({r[:2] for r in rows}, 0)
    for symbol, frame, s, _ in rows:
        want[symbol, frame] += s < last.get(symbol, s)
        last[symbol] = s
    assert {(r.symbol, r.timeframe): r.out_of_order_count for r in quality.out_of_order(df, ["place"]).collect()} == want


def loop_plan(sizes, limit):
    """A shard is closed before a file that doesn't fit, if it holds any, and after one that is larger than a shard."""
    groups, current = [], []
    for i, n in enumerate(sizes):
        if current and sum(sizes[j] for j in current) + n > limit:
            groups.append(current)
            current = []
        current.append(i)
        if n > limit:
            groups.append(current)
            current = []
    return [k for k, own in enumerate([*groups, current]) for _ in own]


@pytest.mark.parametrize("seed", range(12))
def test_shard_plan_against_a_loop(spark, seed):
    rng = random.Random(seed)
    n, most = [(0, 1), (1, 50), (700, 30), (700, 130), (500, 3), (300, 100), (400, 250), (300, 1000), (40, 5000), (1, 200), (900, 1), (600, 60)][seed]
    sizes = [rng.choice([0, rng.randrange(most), most, rng.choice([0, 0, 100, 101])]) for _ in range(n)]
    inv = spark.createDataFrame([(f"p{i:05d}", s) for i, s in enumerate(sizes)], "relative_path string, size_bytes long").repartition(3)
    got = [r.shard for r in shards.shard_plan(inv, 100, (2, 1, 8)[seed % 3]).orderBy("relative_path").collect()]
    assert got == loop_plan(sizes, 100)


@pytest.mark.parametrize("seed", range(6))
def test_shard_plan_of_many_ranges(spark, seed):
    """Cells are joined to ranges by files: as many calls as the files need, not one for each few shards; the plan is that of the loop for any number of files in a range."""
    rng = random.Random(100 + seed)
    most = (30, 130, 3, 1000, 60, 15)[seed]
    sizes = [rng.choice([0, rng.randrange(most), most, rng.choice([0, 0, 100, 101])]) for _ in range(600)] + [0, 2] * (40 * (seed % 2))
    inv = spark.createDataFrame([(f"p{i:05d}", s) for i, s in enumerate(sizes)], "relative_path string, size_bytes long").repartition(3)
    got = shards.shard_plan(inv, 100, (2, 1, 8)[seed % 3], (1, 20, 90)[seed // 2]).orderBy("relative_path").collect()
    assert [r.shard for r in got] == loop_plan(sizes, 100)
    cells = spark.range(1000).select((F.col("id") * 3).alias("place"), F.floor(F.col("id") / 2).alias("own"))
    assert [(r.range, r["count"]) for r in shards.ranges(cells, 300).groupBy("range").count().orderBy("range").collect()] == [(i, 50) for i in range(10)]
    assert shards.ranges(cells, 300).where("near IS NOT NULL").orderBy("own").select("own", "range", "near").first()[:] == (50, 1, 0)


@pytest.mark.parametrize("sizes, want", [([0, 20, 3], [0, 1, 2]), ([20, 0, 0, 3, 20], [0, 1, 1, 1, 2]), ([10, 0, 1], [0, 0, 1]), ([0] * 30, [0] * 30), ([20, 20, 20], [0, 1, 2]), ([10] * 40, list(range(40))), ([1] * 35, [i // 10 for i in range(35)]), ([500, 1, 500, 0], [0, 1, 2, 3])])
def test_shard_plan_edges(spark, sizes, want):
    inv = spark.createDataFrame([(f"p{i:05d}", s) for i, s in enumerate(sizes)], "relative_path string, size_bytes long").repartition(3)
    assert [r.shard for r in shards.shard_plan(inv, 10).orderBy("relative_path").collect()] == want == loop_plan(sizes, 10)


def test_running_sums(spark):
    rows = [(f"k{i:04d}", i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, n long").repartition(6)
    got = ordered.running(df, "key", {"upto": F.col("n")}, {"last": F.col("n")}).orderBy("key").collect()
    assert [(r.place, r.upto) for r in got] == [(i, sum(n for _, n in rows[:i])) for i in range(500)]
    assert all(r.last in (None, rows[i - 1][1]) for i, r in enumerate(got)) and ordered.running(df.limit(0), "key", {}).collect() == []


def test_packs(spark, tmp_path):
    for i, n in enumerate((700, 700, 700, 1200, 5)):  # a shard holds 1024 of these
        p = tmp_path / f"src/bars_daily/symbol=A/date=2025-01-0{i + 1}/part-0.parquet"
        p.parent.mkdir(parents=True)
        p.write_bytes(bytes([i]) * n * 1024)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    inv = inventory.file_inventory(spark, src)
    assert inventory.dataset_summary(inv).first().asDict() == {"dataset": "bars_daily", "file_count": 5, "total_bytes": 3384320, "partition_keys": "date,symbol"}
    dry = packs.create_pack(spark, src, out, "b0", "2026-01-01T00:00:00Z", 1, dry_run=True)
    assert [r.uncompressed_bytes for r in dry.shards.orderBy("shard_index").collect()] == [n * 1024 for n in (700, 700, 700, 1200, 5)] and not (tmp_path / "out").exists()
    assert dry.header["file_count"] == 5 and dry.header["total_archive_bytes"] is None and dry.files.where("checksum IS NOT NULL").isEmpty()
    made = [packs.create_pack(spark, src, out, b, "2026-01-01T00:00:00Z", 1) for b in ("b1", "b2")]
    documents = [json.loads((tmp_path / f"out/{b}/manifest.json").read_text()) for b in ("b1", "b2")]
    assert documents[0]["shards"] == documents[1]["shards"] and documents[0]["files"] == documents[1]["files"] and (tmp_path / "out/b1/manifest.json").read_text() == files.json_text(documents[0])
    assert [(e["relative_path"], e["size_bytes"], e["partitions"]) for e in documents[0]["files"]][4] == ("bars_daily/symbol=A/date=2025-01-05/part-0.parquet", 5120, {"date": "2025-01-05", "symbol": "A"})
    assert [s["shard_name"] for s in documents[0]["shards"]] == [f"shard-00000{i}.zip" for i in range(5)] and documents[0]["source_dataset_root"] == "src" and documents[0]["included_datasets"] == ["bars_daily"]
    assert packs.manifest_errors(packs.read_manifest(spark, f"{out}/b1/manifest.json")) == [] and made[0].path == f"{out}/b1" and packs.validate_pack(spark, f"{out}/b1")["valid"] and files.packs(out) == ["b1", "b2"]
    assert packs.inspect_pack(spark, f"{out}/b1").first().asDict() == {"dataset": "bars_daily", "file_count": 5, "total_bytes": 3384320, "partition_keys": "date,symbol"}
    with pytest.raises(FileExistsError):
        packs.create_pack(spark, src, out, "b1", "2026-01-01T00:00:00Z", 1)
    back = str(tmp_path / "back")
    assert packs.restore_pack(spark, f"{out}/b1", back) == 5 and packs.restore_pack(spark, f"{out}/b1", back, "merge") == 0 and packs.restore_pack(spark, f"{out}/b1", back, "replace") == 5
    assert {r.status for r in inventory.reconcile(inv, inventory.file_inventory(spark, back)).collect()} == {"ok"}
    with pytest.raises(FileExistsError):
        packs.restore_pack(spark, f"{out}/b1", back)
    (tmp_path / "back/bars_daily/symbol=A/date=2025-01-01/part-0.parquet").write_bytes(b"other")
    with pytest.raises(FileExistsError, match="differ"):
        packs.restore_pack(spark, f"{out}/b1", back, "merge")
    shard = tmp_path / "out/b2/shards/shard-000001.zip"
    shard.write_bytes(shard.read_bytes()[:-3])
    assert not packs.validate_pack(spark, f"{out}/b2")["valid"]
    with pytest.raises(ValueError, match="shard-000001"):
        packs.restore_pack(spark, f"{out}/b2", str(tmp_path / "back2"))
    assert not (tmp_path / "back2").exists() and [p.name for p in tmp_path.iterdir() if ".restore-" in p.name] == []
    for wrong in ({"file_count": 4}, {"created_at_utc": "now"}, {"files": [{"relative_path": "../x", "size_bytes": 1, "checksum": None}]}, {"shards": []}, {"artifact_type": "x"}):
        for indent in (2, None):  # the layout that tasks read, and another
            (tmp_path / "wrong.json").write_text(files.json_text(documents[0] | wrong) if indent else json.dumps(documents[0] | wrong))
            assert packs.manifest_errors(packs.read_manifest(spark, str(tmp_path / "wrong.json"))), wrong
    assert packs.create_pack(spark, src, out, None, "2026-01-01T00:00:00Z", 1, dry_run=True).path == f"{out}/backup_20260101_000000_src"
    with zipfile.ZipFile(tmp_path / "out/b1/shards/shard-000000.zip") as z:
        assert z.infolist()[0].date_time == (1980, 1, 1, 0, 0, 0)
    assert not packs.validate_pack(spark, str(tmp_path / "none"))["valid"]


def test_manifests_of_many_entries(spark, tmp_path, monkeypatch):
    """Read in many parts, equal to the document as a whole."""
    monkeypatch.setattr(manifests, "PIECE", 20_000)
    monkeypatch.setattr(manifests, "STEP", 100)
    n, path = 3000, str(tmp_path / "pack/manifest.json")
    entries = spark.range(n).select(F.format_string("bars/symbol=S%d/é\"%05d.parquet", F.col("id") % 7, "id").alias("relative_path"), F.col("id").alias("size_bytes"), F.sha2(F.col("id").cast("string"), 256).alias("checksum"), F.lit("bars").alias("dataset_name"), F.create_map(F.lit("symbol"), F.format_string("S%d", F.col("id") % 7)).alias("partitions"))
    shards = spark.range(30).select(F.format_string("shard-%06d.zip", "id").alias("shard_name"), F.format_string("shards/shard-%06d.zip", "id").alias("relative_path"), F.col("id").alias("shard_index"), F.lit(100).cast("long").alias("file_count"), F.lit(149950).cast("long").alias("uncompressed_bytes"), F.lit(5).cast("long").alias("archive_bytes"), F.lit(None).cast("string").alias("checksum"))
    header = manifests.KIND | {"backup_id": "b", "created_at_utc": "2026-01-01T00:00:00Z", "source_dataset_root": "lake", "shard_size_mb": 1, "included_datasets": ["bars"], "file_count": n, "total_uncompressed_bytes": n * (n - 1) // 2, "total_archive_bytes": 150, "metadata": {"files": [{"a": [1, {"b": 2}]}], "x": {"y": {}}}, "notes": ["{", "    {"], "restore": manifests.RESTORE}
    manifests.write_manifest(header, entries, shards, path)
    text = (tmp_path / "pack/manifest.json").read_text()
    document = json.loads(text)
    assert text == files.json_text(document) and len(document["files"]) == n and len(document["shards"]) == 30 and [p.name for p in (tmp_path / "pack").iterdir()] == ["manifest.json"]
    assert [e["relative_path"] for e in document["files"]] == sorted(e["relative_path"] for e in document["files"]) and {k: v for k, v in document.items() if k not in ("files", "shards")} == header
    assert len(manifests._pieces(path)) > 20
    back = manifests.read_manifest(spark, path)
    assert back.header == header | {"files": [], "shards": []} and manifests.manifest_errors(back) == []
    assert sorted((r.relative_path, r.size_bytes, r.checksum) for r in back.files.collect()) == [(e["relative_path"], e["size_bytes"], e["checksum"]) for e in document["files"]]
    for change, said in (({"file_count": n + 1}, "file_count"), ({"files": document["files"] + document["files"][:1]}, "listed twice"), ({"files": [document["files"][0] | {"size_bytes": True}]}, "no count"), ({"shards": document["shards"][1:]}, "numbered"), ({"files": [1]}, "lists of objects"), ({"shards": {}}, "lists")):
        (tmp_path / "other.json").write_text(files.json_text(document | change))
        assert any(said in e for e in manifests.manifest_errors(manifests.read_manifest(spark, str(tmp_path / "other.json")))), said
    for bad in ("{", "[1]", "nothing", "{\n  x"):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(ValueError):
            manifests.read_manifest(spark, str(tmp_path / "bad.json"))


@pytest.mark.parametrize("path, want", [("a/b", "a/b"), (" a\\b/./c/ ", "a/b/c"), ("a//b", "a/b"), ("/a", None), ("~/a", None), ("C:\\a", None), ("c:a", None), ("\\a", None), ("a/../b", None), ("", None), (".", None), ("./", None), (None, None)])
def test_relative_paths(path, want):
    if want is not None:
        assert manifests.relative(path) == want
    else:
        with pytest.raises(ValueError):
            manifests.relative(path)


def test_listings_by_tasks(spark, tmp_path):
    for symbol in "ABC":
        for day in range(1, 6):
            p = tmp_path / f"bars/symbol={symbol}/date=2024-01-0{day}/part-0.parquet"
            p.parent.mkdir(parents=True)
            p.write_bytes(b"x" * day)
    (tmp_path / "top.parquet").write_bytes(b"")
    (tmp_path / "bars/symbol=A/note.txt").write_bytes(b"1")
    for hidden in ("bars/_x/a.parquet", "bars/.y/b.parquet", "bars/symbol=A/_c.parquet"):
        (tmp_path / hidden).parent.mkdir(exist_ok=True)
        (tmp_path / hidden).write_bytes(b"123")
    want = sorted(p.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("*.parquet"))
    for parts in (1, 2, 4, 64):
        got = listing.listing(spark, str(tmp_path), parts=parts).collect()
        assert sorted(r.relative_path for r in got) == [p for p in want if "/_" not in p and "/." not in p] and sum(r.size_bytes for r in got) == 45
        assert sorted(r.relative_path for r in listing.listing(spark, f"file://{tmp_path}", hidden=True, parts=parts).collect()) == want
    some = listing.listing(spark, str(tmp_path), parts=3).where("symbol = 'B' AND date >= '2024-01-03'").collect()
    assert sorted((r.dataset, r.symbol, r.date, r.size_bytes) for r in some) == [("bars", "B", f"2024-01-0{i}", i) for i in (3, 4, 5)]
    assert listing.listing(spark, str(tmp_path)).where("symbol IS NULL").count() == 1 and listing.listing(spark, str(tmp_path), r".*\.txt").count() == 1 and files.listed(spark, f"{tmp_path}/none").count() == 0
    reader = listing.ListingReader({"path": str(tmp_path)})
    reader.tests = [("symbol", listing.EqualTo, "B")]
    assert [p for part in reader.partitions() for p, _ in part.paths if "symbol=" in p and "symbol=B" not in p] == []


@pytest.mark.parametrize("kind", ["TIMESTAMP_MICROS", "TIMESTAMP_MILLIS", "INT96"])
def test_footers_tell_what_a_scan_tells(spark, tmp_path, kind):
    root = str(tmp_path / "lake/bars_1m")
    spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
    rows = spark.range(600).select(F.element_at(F.array(F.lit("A:b c+d"), F.lit("B"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("symbol"), F.when(F.col("id") % 50 < 40, "1Min").otherwise("5Min").alias("timeframe"), F.when(F.col("id") % 7 > 0, F.timestamp_seconds(F.col("id") * 997)).alias("ts_utc"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")), F.col("id").alias("volume"), F.lit("x").alias("source"))
    rows = rows.withColumns({"date": F.date_format("ts_utc", "yyyy-MM-dd"), "year": F.year("ts_utc")})
    rows.repartition(3).write.partitionBy("symbol", "date").parquet(root)
    want = rows.groupBy("symbol", "timeframe").agg(F.min("ts_utc"), F.max("ts_utc"), F.count("*"))
    assert sorted(map(tuple, footers.bounds(spark, root, BAR).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    by_symbol = rows.groupBy("symbol").agg(F.min("ts_utc"), F.max("ts_utc"), F.count("*"))
    assert sorted(map(tuple, footers.bounds(spark, root, BAR, by=("symbol",)).collect()), key=str) == sorted(map(tuple, by_symbol.collect()), key=str)
    told = footers.footers(spark, root)
    assert told.where("stats['ts_utc'] IS NULL").isEmpty() == (kind != "INT96") and told.agg(F.sum("n_rows")).first()[0] == 600
    assert footers.row_counts(spark, str(tmp_path / "lake")).select("dataset", "row_count").collect() == [("bars_1m", 600)]
    assert footers.bounds(spark, str(tmp_path / "none"), BAR).collect() == []
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")


@pytest.mark.parametrize("pre, post", [(0, 0), (1, 0), (2, 3), (5, 5), (200, 165)])
def test_windows_of_any_width_by_buckets_of_days(spark, pre, post):
    rng = random.Random(pre)
    first = dt.date(2023, 1, 1)
    events = [(f"e{i}", rng.choice("ab"), str(first + dt.timedelta(rng.randrange(700)))) for i in range(40)]
    bars = [(rng.choice("AB"), first + dt.timedelta(rng.randrange(-300, 1000)), float(i)) for i in range(500)]
    got = ew.event_windows(spark.createDataFrame(events, "corporate_action_id string, symbol string, ex_date string"), spark.createDataFrame(bars, "symbol string, date date, open double"), pre, post, guard="plan")
    near = lambda e, b: -pre <= (b - dt.date.fromisoformat(e)).days <= post
    want = sorted((i, b, o) for i, s, e in events for t, b, o in bars if s.upper() == t and near(e, b))
    assert sorted((r.event_corporate_action_id, r.bar_date, r.bar_open) for r in got.collect()) == want and want
    copies = got.selectExpr("event_day_offset").where(f"event_day_offset NOT BETWEEN {-pre} AND {post}")
    assert copies.isEmpty() and (pre + post) // ew.bucket_days(pre, post) + 2 <= ew.COPIES + 2


def test_sorted_windows_are_neither_shuffled_nor_sorted_again(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    first = dt.datetime(2023, 1, 1)
    events = [(f"e{rng.randrange(60)}", rng.choice("ab"), str((first + dt.timedelta(rng.randrange(50))).date()), i / 8) for i in range(400)]
    events += events[:150]  # twice, whose rows lie side by side
    bars = [(s, first + dt.timedelta(d, 3600 * h), d + h / 8) for s in "AB" for d in range(-9, 60) for h in (9, 17) if rng.random() < 0.8]
    ev = spark.createDataFrame(events, "corporate_action_id string, symbol string, ex_date string, cash_amount double")
    br = spark.createDataFrame(bars, "symbol string, ts timestamp, open double").repartition(5)
    key, whole = (lambda r: (r.event_symbol, r.event_date, r.event_corporate_action_id, r.bar_date, r.bar_ts)), (lambda rows: sorted(map(str, rows)))
    plain = ew.event_windows(ev, br, 5, 5, bar_date_field="ts").collect()
    monkeypatch.setattr(ew, "RANGE_ROWS", 700)
    dealt = ew.event_windows(ev, br, 5, 5, bar_date_field="ts", dealt=True)
    plan = dealt.orderBy(*ew.event_order())._jdf.queryExecution().toString().rpartition("Physical Plan")[2]
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan and "REPARTITION_BY_NUM" in plan
    monkeypatch.setattr(ew, "BROADCAST", 0)
    assert whole(ew.event_windows(ev, br, 5, 5, bar_date_field="ts", dealt=True).collect()) == whole(plain)
    out = str(tmp_path / "out")
    said = tables.write_event_windows(dealt, out, 5, 5)
    assert said["row_count"] == len(plain) and len(said["ordered_files"]) > 4
    rows = tables.read_event_windows(spark, out)
    got = rows.collect()
    assert "Exchange" not in rows._jdf.queryExecution().toString() and rows.schema == spark.read.parquet(out).schema
    assert [key(r) for r in got] == sorted(map(key, plain)) and whole(got) == whole(plain)
    assert [tuple(r) for r in tables.read_event_windows(spark, out, ["bar_ts", "event_symbol"]).collect()] == [(r.bar_ts, r.event_symbol) for r in got]
    spark.read.parquet(out).limit(1).write.mode("append").parquet(out)  # a file that the metadata doesn't name
    more = tables.read_event_windows(spark, out).collect()
    assert len(more) == len(got) + 1 and [key(r) for r in more] == sorted(map(key, more))
    tables.write_event_windows(dealt.limit(0), out, 5, 5)
    assert tables.read_event_windows(spark, out).collect() == []


def test_guards_in_the_plan(spark):
    bars = spark.createDataFrame([("A", "2025-01-02", 1.0), (" ", "2025-01-03", 2.0)], "symbol string, ts string, open double")
    events = spark.createDataFrame([("e", "A", "2025-01-02")], "corporate_action_id string, symbol string, ex_date string")
    with pytest.raises(ValueError, match="1 bars lack a symbol"):
        ew.event_windows(events, bars)
    lazy = ew.event_windows(events, bars, symbol="A", guard="plan")
    with pytest.raises(Exception, match="some bars lack a symbol"):
        lazy.collect()
    assert ew.event_windows(events, bars.where("symbol = 'A'"), guard="plan").count() == 1
    raw = spark.createDataFrame([("noon", 1.0), ("2025-01-02T09:00:00Z", 2.0)], "timestamp string, open double").withColumns({c: F.col("open") for c in ("high", "low", "close", "volume", "ordinal")})
    with pytest.raises(Exception, match="some timestamps can't be parsed"):
        normalize.normalize_bars(raw, "A", "x", "1D", guard="plan").collect()
    rules = (F.try_to_timestamp("timestamp").isNull(), "{n} timestamp can't be parsed"), (F.col("open") < 2, "{n} price is low")
    assert [r.errors for r in normalize.with_errors(raw, *rules).orderBy("open").collect()] == [["this timestamp can't be parsed", "this price is low"], []]
    with pytest.raises(ValueError, match="unknown guard"):
        normalize.checked(raw, rules[0], guard="none")


def test_scans_are_pruned_by_events(spark, tmp_path, dividends):
    root, snap = str(tmp_path / "lake"), str(tmp_path / "snap")
    tables.write_snapshot(dividends, snap)  # AAPL 2025-01-10, MSFT 2024-02-09
    days = spark.range(40).select(F.expr("explode(array('AAPL', 'msft', 'ZZZ'))").alias("symbol"), F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    rows = days.select("symbol", F.lit("1D").alias("timeframe"), F.lit("x").alias("source"), F.col("day").cast("timestamp").alias("ts_utc"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")), F.lit(1).cast("long").alias("volume"), F.year("day").alias("year"), F.col("day").cast("string").alias("date"))
    tables.write_bars(rows, root)
    near = tables.bars_near(spark, root, tables.read_snapshot(spark, snap), 2, 3)
    assert sorted((r.symbol, r.date) for r in near.collect()) == [("AAPL", f"2025-01-{d:02d}") for d in range(8, 14)]
    plan = near._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    got = tables.snapshot_windows(spark, snap, root, 2, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, tables.snapshot_windows(spark, snap, tables.read_bars(spark, root), 2, 3).collect())) and got.count() > 0


def test_versions_are_swapped_whole(spark, tmp_path, dividends):
    root, one = str(tmp_path / "mart"), dividends.where("symbol = 'MSFT'")
    tables.write_mart(dividends, root)  # a plain table
    before = tables.read_mart(spark, root)
    said = tables.write_mart(one, root, keep=2)
    assert (said["row_count"], before.count(), tables.read_mart(spark, root).count()) == (1, 3, 1) and tables.validate_mart(spark, root)["valid"]
    held = tables.read_mart(spark, root)

    def fails(path):
        one.write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.replaced(root, fails)
    assert tables.read_mart(spark, root).count() == 1
    tables.write_mart(dividends, root, keep=2)
    assert held.count() == 1 and tables.read_mart(spark, root).count() == 3 and sorted(p.name for p in (tmp_path / "mart").iterdir()) == ["_current.json", "_versions"]
    tables.write_mart(one, root, keep=2)
    assert len(list((tmp_path / "mart/_versions").iterdir())) == 2 and tables.read_mart(spark, root).count() == 1 and versions.current(root).rpartition("/")[2].startswith("00000003-")
    snap, out = str(tmp_path / "snap"), str(tmp_path / "out")
    assert tables.write_snapshot(dividends, snap, "2024-01-01", "2025-12-31", keep=1)["written_record_count"] == 2 and tables.read_snapshot(spark, snap).count() == 2  # one comes twice
    assert tables.mart_from_snapshot(spark, snap, str(tmp_path / "mart2"))["ingest_start_date"] == "2024-01-01"
    bars = spark.createDataFrame([("AAPL", "2025-01-10", 1.0)], "symbol string, date string, open double")
    for n in (1, 2):
        assert tables.write_event_windows(tables.snapshot_windows(spark, snap, bars, 1, 1), out, 1, 1, snap, keep=1)["row_count"] == tables.read_event_windows(spark, out).count() > 0
    with pytest.raises(ValueError):
        tables.write_mart(one, f"{tmp_path}/curated/x", keep=2)


def test_save_plan(spark):
    listed = spark.createDataFrame([(p, 2) for p in ("a/b/c", "a/bc", "a/.x/y", "d", "e/f")], files.LISTING)
    assert [r.relative_path for r in composites.save_plan(listed, ["a/", "d"], ["a/b"]).collect()] == ["a/bc", "d"]
    assert tuple(composites.plan_summary(composites.save_plan(listed, [""])).first()) == (4, 8)


def test_small_parts(spark, dividends):
    from tickloom.functions.columns import is_utc_text
    from tickloom.operators import dividends as dv

    times = spark.createDataFrame([("2025-01-02T03:04:05Z",), ("2025-01-02T03:04:05",), ("2025-13-02T03:04:05Z",), (None,)], "t string")
    assert [r[0] for r in times.select(is_utc_text("t")).collect()] == [True, False, False, False]
    assert files.united(["b", "a"], ["a", "c"]) == ["b", "a", "c"]
    assert dv.checked_date_field("ex_date") == "ex_date" and [r.date_field for r in dv.date_uses(spark).where("anchor").collect()] == ["ex_date"]
    with pytest.raises(ValueError):
        dv.checked_date_field("date")
    raw = spark.createDataFrame([("2", "b", "cash_dividend", "2025-01-02"), ("1", "a", "cash_dividend", "2025-01-02"), ("1", "a", "cash_dividend", "2025-01-02")], "id string, symbol string, type string, ex_date string")
    assert [r.symbol for r in dv.normalize_batch(raw).collect()] == ["A", "A", "B"]


def test_ingest_composite(spark, tmp_path):
    path = str(tmp_path / "snap")
    options = {"symbols": "aapl,msft", "transport": "tests.test_bars:fake_actions", "start": "2025-01-01", "end": "2025-12-31"}
    meta = composites.ingest_dividends(spark, options, path)
    assert (meta["record_count"], meta["nested_cash_dividend_count"], meta["nested_stock_dividend_count"], meta["ingest_start_date"]) == (3, 2, 1, "2025-01-01")
    assert sorted((r.symbol, r.corporate_action_type, r.cash_amount) for r in tables.read_snapshot(spark, path).collect()) == [("AAPL", "cash_dividend", 0.25), ("MSFT", "cash_dividend", 0.25), ("MSFT", "stock_dividend", None)]
    with pytest.raises(ValueError):
        composites.ingest_dividends(spark, options, str(tmp_path / "curated" / "x"))
