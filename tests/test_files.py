"""Raw files through ingest, store, verification and reports."""

from __future__ import annotations

import json
import os
import re

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candlewarden.functions.session import materialise
from candlewarden.operators import checks, normalise, parse
from candlewarden.plans import ingest
from candlewarden.schema import ExportLayoutError
from candlewarden.sources import digest, files, store
from conftest import HEADER, export_name, text_lines, write_export


def test_identity_from_name(spark):
    good = "NGAS7_M15_202003020015_202109301745.csv"
    bad = ["ngas_M15_202003020015_202109301745.csv", "NGAS_H4_202003020015_202109301745.csv", "NGAS_H1_2020_2021.csv", "notes.csv"]
    got = {r["file"]: r for r in parse.file_identity(spark.createDataFrame([(n,) for n in [good, *bad]], "file string")).collect()}
    row = got[good]
    assert (row["symbol"], row["timeframe"], row["declared_end"], row["dataset_id"]) == ("NGAS7", "M15", "202109301745", "NGAS7_M15")
    assert row["ok"] and not any(got[n]["ok"] for n in bad)


def test_unknown_names_and_missing_files_are_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path / "absent"))
    (tmp_path / "notes.csv").write_text(HEADER + "\n")
    with pytest.raises(ValueError, match="notes.csv"):
        files.read_raw(spark, str(tmp_path))


ROW = "2019.07.08\t09:45:00\t61.25\t62.5\t60\t61\t7\t3\t4"


@pytest.mark.parametrize(
    "content",
    ["time;price\n09:30;17\n", HEADER.replace("<VOL>\t", "") + "\n", "", "\n\n", f"\n{HEADER}\n{ROW}\n", f"   \n{HEADER}\n{ROW}\n", f"\t\n{HEADER}\n{ROW}\n"],
)
def test_wrong_header_is_refused(spark, tmp_path, content):
    (tmp_path / "XAUUSD_H1_202401010000_202401020000.csv").write_text(content)
    with pytest.raises(ExportLayoutError):
        files.read_raw(spark, str(tmp_path))


def test_marked_file_with_semicolons_and_odd_cells(spark, tmp_path):
    cells = [
        ["2019.07.08", "09:45:00", "61.25", "62.5", "60", "61", "7", "3", "4"],
        ["2019.7.9", "9:45:00", "?", "nan", "-inf", "0x10", "", "5.0", "many"],
        ["2019.07.10", "10:00:00", "61"],
    ]
    lines = [HEADER.replace("\t", ";"), ";".join(cells[0]), "", "", ";".join(cells[1]), ";".join(cells[2])]
    (tmp_path / "COAL_M15_201907080000_201907110000.csv").write_text("\ufeff" + "\n".join(lines), encoding="utf-8")
    rows = {r["line_no"]: r for r in files.read_raw(spark, str(tmp_path))[0].collect()}
    assert set(rows) == {2, 3, 4}  # blank lines have no number
    assert (rows[2]["high"], rows[2]["tick_volume"], rows[2]["spread"]) == (62.5, 7, 4)
    assert [rows[3][c] for c in ("open", "high", "low", "close")] == [None, None, float("-inf"), None]
    assert [rows[3][c] for c in ("tick_volume", "volume", "spread")] == [None, 5, None]
    assert rows[3]["ts"] == pd.Timestamp("2019-07-09 09:45")
    assert rows[4]["open"] == 61 and rows[4]["high"] is None and rows[4]["spread"] is None


@pytest.mark.parametrize("size", [None, 60], ids=["one split", "many splits"])
def test_data_and_physical_lines(spark, tmp_path, size):
    """Blank lines are no data; a line of tabs is blank only where tabs do not separate."""
    rows = [ROW.replace("61.25", f"{k}.5") for k in range(1, 5)]
    body = [HEADER, rows[0], "", "   ", rows[1], "", rows[2], "\t\t", rows[3], "", ""]
    (tmp_path / "COAL_M15_201907080000_201907110000.csv").write_text("\n".join(body) + "\n")
    commas = [x.replace("\t", ",") for x in body]
    commas[7] = "\t \t"
    (tmp_path / "IRON_M15_201907080000_201907110000.csv").write_text("\n".join(commas) + "\n")
    if size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        typed = files.read_raw(spark, str(tmp_path))[0].select("symbol", "line_no", "physical_line", "open").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = sorted((r["symbol"], r["line_no"], r["physical_line"], r["open"]) for r in typed)
    assert found == [
        ("COAL", 2, 2, 1.5), ("COAL", 3, 5, 2.5), ("COAL", 4, 7, 3.5), ("COAL", 5, 8, None), ("COAL", 6, 9, 4.5),
        ("IRON", 2, 2, 1.5), ("IRON", 3, 5, 2.5), ("IRON", 4, 7, 3.5), ("IRON", 5, 9, 4.5),
    ]


@pytest.mark.parametrize("cells", [["0.25"] * 9, ["7"] * 10], ids=["fraction", "ten cells"])
def test_rows_that_refuse_their_file(spark, tmp_path, cells):
    row = "\t".join(["2019.07.08", "09:45:00", *cells[2:]])
    (tmp_path / "COAL_M15_201907080000_201907110000.csv").write_text(f"{HEADER}\n{row}\n")
    with pytest.raises(ExportLayoutError):
        files.read_raw(spark, str(tmp_path))


def test_line_numbers_survive_many_splits(spark, tmp_path, m15):
    path = write_export(tmp_path, m15)
    other = m15.assign(symbol="EURUSD")
    write_export(tmp_path, other.head(100))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        lines = files.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r["line_no"]: r["value"] for r in lines if r["file"] == export_name(m15)}
    expected = open(path).read().splitlines()
    assert got == {i: text for i, text in enumerate(expected, 1)}
    assert sum(r["file"] == export_name(other.head(100)) for r in lines) == 101


def test_ingest_end_to_end(spark, tmp_path, h1, m30, m15):
    raw = tmp_path / "raw"
    raw.mkdir()
    for bars in (h1, m30, m15):
        write_export(raw, bars)
    sources = {p.name: p.read_bytes() for p in raw.iterdir()}
    manifests, reports = ingest.run(spark, str(raw), str(tmp_path / "p"), str(tmp_path / "r"))
    rows = {r["dataset_id"]: r for r in manifests.collect()}
    assert set(rows) == {"XAUUSD_H1", "XAUUSD_M30", "XAUUSD_M15"}
    for r in rows.values():
        assert len(r["source_sha256"]) == 64
        assert r["source_size_bytes"] == len(sources[r["source_filename"]])
        assert r["rows"] == r["normalization"]["rows_in"] == r["normalization"]["rows_out"]
        assert not r["normalization"]["reordered"]
    assert rows["XAUUSD_H1"]["rows"] == len(h1)
    assert {r["overall"] for r in reports.overall.collect()} <= {"PASS", "WARN"}
    tiers = {r["tier"]: r for r in reports.tiers.collect()}
    assert tiers["H1_only"]["start_ts"] < tiers["H1_M30"]["start_ts"] < tiers["H1_M30_M15"]["start_ts"]
    assert all(t["valid"] for t in tiers.values())
    assert reports.checks.count() == 3 * 14
    assert reports.cross_timeframe.count() == 3 and reports.conflicts.count() == 0
    assert all(r["ok"] for r in store.verify_datasets(spark, str(tmp_path / "p")).collect())
    bars, manifest = store.load_dataset(spark, str(tmp_path / "p"), "XAUUSD_H1")
    got = bars.orderBy("ts").toPandas()
    pd.testing.assert_frame_equal(got[list(h1.columns)], h1, check_dtype=False)
    assert manifest["schema_version"] == "1.0.0"
    # the contract travels with the file
    field = json.loads(spark.read.parquet(str(tmp_path / "p" / "bars")).schema["close"].json())
    assert field["metadata"]["schema_version"] == "1.0.0"

    again, _ = ingest.run(spark, str(raw), str(tmp_path / "p2"), str(tmp_path / "r2"))
    hashes = {r["dataset_id"]: r["content_sha256"] for r in again.collect()}
    assert hashes == {k: r["content_sha256"] for k, r in rows.items()}

    # changing one stored value is found, and only there; other datasets still verify
    root = str(tmp_path / "p2")
    assert tampered(spark, root, "timeframe = 'H1'", lambda t: t.assign(close=t["close"].where(t.index > 0, t["close"] + 1))) == 1
    with pytest.raises(ValueError, match="content hash mismatch"):
        store.load_dataset(spark, root, "XAUUSD_H1")
    assert store.load_dataset(spark, root, "XAUUSD_H1", check=False)[0].count() == len(h1)
    verdicts = {r["timeframe"]: r["ok"] for r in store.verify_datasets(spark, root).collect()}
    assert verdicts == {"H1": False, "M30": True, "M15": True}
    asked = store.verify_datasets(spark, root, ["XAUUSD_M15", "XAUUSD_D1"]).collect()
    assert {(r["timeframe"], r["problem"]) for r in asked} == {("M15", None), ("D1", "no manifest")}
    months = store.verify_months(spark, root, changed_only=True).collect()
    assert [(r["timeframe"], r["month"], r["rows"], r["expected_rows"]) for r in months] == [("H1", "2023-09", len(h1), len(h1))]

    # a file that states another version is refused, whatever the manifest says
    root = str(tmp_path / "p")
    assert tampered(spark, root, "timeframe = 'M15'", lambda t: t.assign(schema_version="0.9.0")) >= 1
    with pytest.raises(ValueError, match="schema version.*0.9.0"):
        store.load_dataset(spark, root, "XAUUSD_M15")
    assert store.load_dataset(spark, root, "XAUUSD_H1")[0].count() == len(h1)


def local(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def tampered(spark, root, where, change) -> int:
    """Rewrite the stored files that hold rows of one series; returns how many there are."""
    found = [r[0] for r in store.read_stored(spark, root).where(where).select(F.col("_metadata.file_path")).distinct().collect()]
    for path in found:
        path = local(path)
        table = pq.ParquetFile(path).read()
        frame = table.to_pandas(types_mapper=pd.ArrowDtype)
        hit = frame.query(where.replace(" = ", " == ")).index
        frame.loc[hit] = change(frame.loc[hit].reset_index(drop=True)).set_index(hit)
        pq.write_table(pa.Table.from_pandas(frame, table.schema, preserve_index=False), path)
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    return len(found)


@pytest.mark.parametrize(
    ("step", "after"), [("write_files", True), ("write_bars", True), ("write_manifests", True), ("commit", False), ("commit", True)]
)
def test_an_ingest_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, h1, step, after):
    """Killed before or after each step: readers see all of the old store, or (after the commit) all of the new one."""
    raw, root = tmp_path / "raw", str(tmp_path / "p")
    raw.mkdir()
    write_export(raw, h1)
    write_export(raw, h1.assign(symbol="COAL"))
    ingest.ingest(spark, str(raw), root)

    def state():
        rows = {(r["symbol"], r["close"]) for r in store.read_bars(spark, root).select("symbol", "close").collect()}
        return rows, {(r["symbol"], r["content_sha256"]) for r in store.read_manifests(spark, root).collect()}

    old = state()
    write_export(raw, h1.assign(close=h1["close"] + 1, high=h1["high"] + 1))
    real = getattr(store.Change, step)

    def dies(self, *args, **kwargs):
        if after:
            real(self, *args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store.Change, step, dies)
        with pytest.raises(KeyboardInterrupt):
            ingest.ingest(spark, str(raw), root)
    seen = state()
    assert (seen == old) == (not (step == "commit" and after))
    assert all(r["ok"] for r in store.verify_datasets(spark, root).collect())
    assert store.verify_months(spark, root).isEmpty()
    if step == "commit":
        ingest.ingest(spark, str(raw), root)
        new = state()
        assert new != old and {c for s, c in new[0] if s == "COAL"} == {c for s, c in old[0] if s == "COAL"}


def test_folders_do_not_grow_with_symbols_and_one_series_is_pruned(spark, tmp_path, to_bars, h1):
    root = str(tmp_path / "p")
    many = pd.concat([h1.assign(symbol=f"S{k}") for k in range(150)])
    bars = to_bars(many).withColumn("line_no", F.lit(None).cast("bigint"))
    manifests = manifests_of(bars)
    change = store.Change(spark, root, buckets=8)
    change.write_bars(bars, manifests)
    change.write_manifests(manifests)
    change.commit()
    folders = [p for p in (tmp_path / "p" / "bars").rglob("*") if p.is_dir()]
    assert len(folders) <= 1 + 8
    one = store.read_bars(spark, root, ["S77_H1"]).where("ts >= TIMESTAMP_NTZ'2023-09-14'")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(symbol,S77)" in plan and "GreaterThanOrEqual(ts" in plan
    assert one.count() == (h1["ts"] >= "2023-09-14").sum()
    assert one.select(F.col("_metadata.file_path")).distinct().count() <= 2


def manifests_of(bars):
    known = digest.content_digest(bars).withColumn("schema_version", F.lit(store.SCHEMA_VERSION))
    fields = [f for f in store.MANIFEST_SCHEMA if f.name not in ("change", "change_series")]
    cells = [F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return materialise(known.select(*cells), "manifests")


def stored_as(spark, root, bars):
    change, manifests = store.Change(spark, root), manifests_of(bars)
    change.write_bars(bars, manifests)
    change.check(manifests)
    change.write_manifests(manifests)
    return change


def test_changes_of_a_series_replace_each_other_and_compact(spark, tmp_path, to_bars, h1, m15):
    root = str(tmp_path / "p")
    first = to_bars(pd.concat([h1, m15, h1.assign(symbol="COAL")]), line_numbers=True)
    stored_as(spark, root, first).commit()
    stored_as(spark, root, to_bars(h1.head(50), line_numbers=True)).commit()
    counts = lambda: {(r["symbol"], r["timeframe"]): r["count"] for r in store.read_bars(spark, root).groupBy("symbol", "timeframe").count().collect()}
    expected = {("XAUUSD", "H1"): 50, ("XAUUSD", "M15"): len(m15), ("COAL", "H1"): len(h1)}
    assert counts() == expected
    assert store.read_bars(spark, root, ["XAUUSD_H1"]).count() == 50
    assert store.read_manifests(spark, root).count() == 3
    before = store.current(spark, root)
    assert store.compact(spark, root).number == before.number + 1
    assert counts() == expected and all(r["ok"] for r in store.verify_datasets(spark, root).collect())
    gone = store.vacuum(spark, root)
    assert len([p for p in (tmp_path / "p" / "bars").iterdir() if p.is_dir()]) == 1 and gone
    assert counts() == expected and store.verify_months(spark, root).isEmpty()


def test_two_writers_from_one_snapshot(spark, tmp_path, to_bars, h1):
    root = str(tmp_path / "p")
    stored_as(spark, root, to_bars(h1, line_numbers=True)).commit()
    a, b = (stored_as(spark, root, to_bars(h1.head(n), line_numbers=True)) for n in (10, 20))
    a.commit()
    with pytest.raises(RuntimeError, match="another change"):
        b.commit()
    assert store.read_bars(spark, root).count() == 10


def test_only_changed_files_are_read_again(spark, tmp_path, monkeypatch, to_bars, h1):
    root = str(tmp_path / "p")
    many = pd.concat([h1.assign(symbol=f"S{k}") for k in range(12)])
    stored_as(spark, root, to_bars(many, line_numbers=True)).commit()
    seen = []
    real = store.leaves
    monkeypatch.setattr(store, "leaves", lambda df: seen.append([r[0] for r in df.select("_metadata.file_name").distinct().collect()]) or real(df))
    assert store.verify_months(spark, root, changed_only=True).isEmpty() and seen[-1] == []
    assert tampered(spark, root, "symbol = 'S5'", lambda t: t.assign(spread=t["spread"].where(t.index != 3, t["spread"] + 1))) >= 1
    found = store.verify_months(spark, root, changed_only=True).collect()
    assert [(r["symbol"], r["month"]) for r in found] == [("S5", "2023-09")]
    assert 1 <= len(seen[-1]) <= 2
    # a file that is gone is missed
    path = store.read_stored(spark, root).where("symbol = 'S9'").select("_metadata.file_path").first()[0]
    os.remove(local(path))
    lost = {r["symbol"]: (r["rows"], r["expected_rows"]) for r in store.verify_months(spark, root, changed_only=True).collect()}
    assert lost["S9"][0] < lost["S9"][1]


def test_a_series_whose_files_lack_a_column(spark, tmp_path, to_bars, h1):
    root = str(tmp_path / "p")
    stored_as(spark, root, to_bars(pd.concat([h1, h1.assign(symbol="COAL")]), line_numbers=True)).commit()
    assert store.column_drift(spark, root).isEmpty()
    tampered(spark, root, "symbol = 'COAL'", lambda t: t.assign(spread=pd.NA))
    assert [(r["symbol"], r["column"], r["rows_without"]) for r in store.column_drift(spark, root).collect()] == [("COAL", "spread", len(h1))]
    bars = store.read_bars(spark, root)
    verdict = {r["symbol"]: (r["status"], r["missing"]) for r in checks.schema_check(bars, bars.select("symbol", "timeframe").distinct()).collect()}
    assert verdict == {"COAL": ("FAIL", "spread"), "XAUUSD": ("PASS", "")}
    results = checks.run_all(bars).collect()
    assert [r["check_name"] for r in results if r["symbol"] == "COAL"] == ["schema", "row_count"]
    assert sum(r["symbol"] == "XAUUSD" for r in results) == 14


def test_damaged_export_is_counted(spark, tmp_path, h1):
    """A backwards export with two copies, three variants of one bar and four kinds of unusable rows."""
    variants = [h1.iloc[[20]].assign(low=h1["low"].iloc[20] - k) for k in (1, 2)]
    extra = [line for bars in (h1.iloc[[11]], h1.iloc[[12]], *variants) for line in text_lines(bars)]
    extra += [f"{d}\t{t}\t{o}\t9\t7\t8\t3\t0\t2" for d, t, o in (("2024.02.31", "04:00:00", "8"), ("", "", "8"), ("2024.03.01", "25:00:00", ""), ("2024.03.01", "04:00:00", "-"))]
    write_export(tmp_path, h1.iloc[::-1], extra)
    typed, _ = files.read_raw(spark, str(tmp_path))
    log = normalise.normalisation_log(typed).first()
    assert (log["rows_in"], log["rows_out"]) == (len(h1) + 8, len(h1))
    assert (log["dropped_unparseable_timestamp"], log["dropped_nan_ohlc"]) == (3, 1)
    assert (log["exact_duplicates_removed"], log["conflicting_duplicate_groups"], log["conflicting_duplicate_rows_removed"]) == (2, 1, 2)
    assert log["reordered"]
    rows = normalise.conflicting_rows(normalise.usable(typed)).orderBy("line_no").collect()
    assert [r["kept"] for r in rows] == [True, False, False]
    kept = normalise.canonical(normalise.resolve(normalise.usable(typed))).orderBy("ts").toPandas()
    assert kept["low"].tolist() == h1["low"].tolist()


def test_a_series_that_is_emptied(spark, tmp_path, h1):
    """Its bars go, its manifest says so, other series stay, and other jobs keep their tables."""
    raw, store_dir, reports = tmp_path / "raw", str(tmp_path / "p"), str(tmp_path / "r")
    raw.mkdir()
    path = write_export(raw, h1)
    write_export(raw, h1.assign(symbol="COAL"))
    pending = materialise(spark.range(5).toDF("id"), "pending")
    ingest.run(spark, str(raw), store_dir, reports)
    with open(path, "w") as f:
        f.write(HEADER + "\n")
    manifests, _ = ingest.run(spark, str(raw), store_dir, reports)
    rows = {r["symbol"]: r["rows"] for r in manifests.collect()}
    assert rows == {"XAUUSD": 0, "COAL": len(h1)}
    assert {r["symbol"] for r in store.read_bars(spark, store_dir).select("symbol").distinct().collect()} == {"COAL"}
    assert all(r["ok"] for r in store.verify_datasets(spark, store_dir).collect())
    assert pending.count() == 5


def test_what_ingest_leaves_out_is_stored(spark, tmp_path, h1):
    raw, root = tmp_path / "raw", str(tmp_path / "p")
    raw.mkdir()
    conflicts = [line for k in range(30) for line in text_lines(h1.iloc[[k]].assign(close=h1["close"].iloc[k] + 1))]
    write_export(raw, h1, conflicts, name="XAUUSD_H1_202401010000_202402190000.csv")
    write_export(raw, h1.head(5), name="XAUUSD_H1_202401010000_202401190000.csv")
    _, reports = ingest.run(spark, str(raw), root, str(tmp_path / "r"))
    assert reports.conflicts.count() == 60 and reports.conflicts.where("kept").count() == 30
    gone = store.read_table(spark, root, ingest.SUPERSEDED).collect()
    assert [(r["file"], r["counting_file"]) for r in gone] == [
        ("XAUUSD_H1_202401010000_202401190000.csv", "XAUUSD_H1_202401010000_202402190000.csv")
    ]


def test_header_only_file_fails_its_checks(spark, tmp_path, h1):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_export(raw, h1)
    (raw / "EURUSD_H1_202401010000_202401020000.csv").write_text(HEADER + "\n")
    _, reports = ingest.run(spark, str(raw), str(tmp_path / "p"), str(tmp_path / "r"))
    verdict = {r["symbol"]: r["overall"] for r in reports.overall.collect()}
    assert verdict["EURUSD"] == "FAIL" and verdict["XAUUSD"] != "FAIL"
    assert reports.coverage.count() == 1


def test_last_export_of_a_series_counts(spark, tmp_path, h1):
    write_export(tmp_path, h1, name="XAUUSD_H1_202401010000_202401190000.csv")
    write_export(tmp_path, h1.head(10), name="XAUUSD_H1_202401010000_202402190000.csv")
    typed, known = files.read_raw(spark, str(tmp_path))
    assert known.count() == 1 and typed.count() == 10


def test_source_digest_sees_every_byte_and_no_split(spark, tmp_path):
    def of(name, content):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.csv").write_bytes(content)
        row = digest.source_digest(spark, str(folder), "*.csv").first()
        assert row["source_size_bytes"] == len(content)
        return row["source_sha256"]

    content = b"".join(b"line %d of a file\n" % k for k in range(500)) + b"\n\nend\n"
    changes = {
        "byte": content.replace(b"line 7 ", b"line 8 ", 1),
        "ending": content.replace(b"\n", b"\r\n", 1),
        "last": content[:-1],
        "blank": content.replace(b"\n\n\n", b"\n\n"),
        "swapped": content.replace(b"line 3 of a file\nline 4 of", b"line 4 of a file\nline 3 of"),
    }
    whole = of("whole", content)
    assert len({whole, *(of(k, c) for k, c in changes.items())}) == 6
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert of("split", content) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_digest_ignores_layout_and_sees_values(spark, to_bars, h1):
    def of(df):
        return digest.content_digest(df).collect()[0]["content_sha256"]

    bars = to_bars(h1)
    same = bars.withColumn("junk", F.lit(1)).repartition(5, "close")
    assert of(bars) == of(same)
    for column, step in (("spread", 1), ("close", 1e-9)):
        changed = h1.copy()
        changed[column] = changed[column].astype(float) if column == "close" else changed[column]
        changed.loc[3, column] += step
        assert of(to_bars(changed)) != of(bars)
    assert of(bars.unionByName(bars.limit(1))) != of(bars)
