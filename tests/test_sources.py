import csv
import io
import json
import zipfile
from datetime import date

import pytest

from pyspark.sql import functions as F

from leadrank import rules
from leadrank.plans.regulatory import RAW_COLUMNS, Build
from leadrank.sources import archives, incremental, text_files
from leadrank.sources.store import Store


def as_csv(header, rows):
    buffer = io.StringIO()
    writer = csv.writer(buffer, quoting=csv.QUOTE_ALL, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    return buffer.getvalue()


def test_chunks_and_quoting(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"c{i}.csv").write_text(as_csv(["id", "text"], [(i, 'a "quoted", line\nnext'), (i + 10, "")]))
    rows = {r.id: r.text for r in text_files.read_csv_chunks(spark, str(tmp_path)).collect()}
    assert rows["0"] == 'a "quoted", line\nnext' and rows["10"] is None and len(rows) == 6


def test_archives_by_member(spark, tmp_path):
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"t_{a}.zip", "w") as z:
            for m in range(3):
                z.writestr(f"m{m}.csv", "﻿" + as_csv(["x", "id"], [("v,1\n2", f"{a}{m}{i}") for i in range(4)] + [("", "z")]))
    got = archives.read_archives(spark, f"{tmp_path}/*.zip", ["id", "x"]).collect()
    assert len(got) == 30 and sum(r.x is None for r in got) == 6 and {r.x for r in got} == {"v,1\n2", None}


HEADERS = list(rules.EMISSION_COLUMNS.values())


def emission_file(path, rows, header=HEADERS):
    full = [{**{"1. YEAR": "2024", "8. ST": "MI", "44. METAL": "YES", "49. FORM TYPE": "R",
                "50. UNIT OF MEASURE": "Pounds", "52. 5.2 - STACK AIR": "0"}, **r} for r in rows]
    path.write_text("﻿" + as_csv(header, [[r.get(h, "") for h in header] for r in full]))
    return str(path)


def test_emission_files(spark, tmp_path):
    ok = emission_file(tmp_path / "TRI_2024_MI.csv", [{"4. FACILITY NAME": "HILL", "51. 5.1 - FUGITIVE AIR": "1.5"}])
    rows = text_files.require_contract(text_files.read_emission_files(spark, [ok])).collect()
    assert [(r.year, r.facility_name, r.file_state) for r in rows] == [("2024", "HILL", "MI")]
    with pytest.raises(ValueError, match="missing columns: 44. METAL"):
        text_files.read_emission_files(spark, [emission_file(tmp_path / "TRI_2024_OH.csv", [], [h for h in HEADERS if h != "44. METAL"])])
    with pytest.raises(ValueError, match="unexpected"):
        text_files.read_emission_files(spark, [emission_file(tmp_path / "TRI_2024_ZZ.csv", [])])
    wrong = emission_file(tmp_path / "TRI_2024_PA.csv", [{}])
    with pytest.raises(ValueError, match="state in a file of PA"):
        text_files.require_contract(text_files.read_emission_files(spark, [wrong]))


def test_whole_build(spark, tmp_path, monkeypatch):
    raw, work, out = (tmp_path / n for n in ("raw", "work", "out"))
    raw.mkdir()
    tables = {
        "inspection": [
            ["101", "Hill Forge Co", "1 Elm Street", "TOWN", "MI", "48104", "332111", "45", "A", "H", "2024-01-05", ""],
            ["102", "HILL FORGE INC", "1 Elm St", "TOWN", "MI", "48104-9", "332111", "45", "A", "H", "2024-05-05", ""],
            ["103", "Oak Mill", "2 Oak Rd", "CITY", "OH", "44101", "321113", "30", "A", "H", "2024-03-01", ""],
            ["104", "Public Works", "3 Oak Rd", "CITY", "OH", "44101", "321113", "30", "B", "H", "2024-03-01", ""],
            ["105", "Far Away", "4 Oak Rd", "CITY", "ZZ", "44101", "321113", "30", "A", "H", "2024-03-01", ""],
            ["106", "Too Old", "4 Oak Rd", "CITY", "OH", "44101", "321113", "30", "A", "H", "2018-03-01", ""]],
        "violation": [
            ["101", "01001", "19100094 A01", "S", "2024-02-01", "100.5", "200", "", "", ""],
            ["102", "01001", "19101053 D", "S", "2024-06-01", "", "300", "", "", ""],
            ["102", "01002", "19100147 C", "S", "2024-06-01", "", "300", "", "", "X"],
            ["103", "01001", "19100134 E", "O", "2023-06-01", "", "", "2023-07-01", "", ""],
            ["105", "01001", "19100094 A01", "S", "2024-02-01", "1", "1", "", "", ""]],
        "emphasis_codes": [["103", "DUSTEXPL"]],
        "accident_injury": [["900", "105", "1"], ["901", "103", "3"]],
        "accident": [["900", "2024-01-01"], ["901", "2024-01-01"]],
    }
    for name, rows in tables.items():
        (raw / name).mkdir()
        with zipfile.ZipFile(raw / name / "1.zip", "w") as z:
            z.writestr("part_0.csv", as_csv(RAW_COLUMNS[name], rows) + ("1,2\n" if name == "violation" else ""))
    with zipfile.ZipFile(raw / "zip_gazetteer.zip", "w") as z:
        z.writestr("gaz.txt", "GEOID\ta\tb\tc\td\tLAT\tLON \n48104\t1\t1\t1\t1\t42.2\t -83.7  \n")
    files = [emission_file(raw / "TRI_2024_MI.csv", [{"4. FACILITY NAME": "Hill Forge", "9. ZIP": "48104", "37. CHEMICAL": "LEAD",
                                                      "51. 5.1 - FUGITIVE AIR": "2", "30. PRIMARY NAICS": "332"}])]
    build = Build(spark, str(raw), str(work), str(out), emission_files=files)
    with pytest.raises(ValueError, match="no emission file for: .*OH"):
        build.run()
    files += [emission_file(raw / f"TRI_2024_{s}.csv", []) for s in rules.TERRITORY if s != "MI"]
    t = build.run()  # the second load finds the archives unchanged and parses none
    assert {name: list(build.loaded.parts(name)) for name in RAW_COLUMNS} == {name: ["1"] for name in RAW_COLUMNS}
    assert [r.passed for r in t["checks"].collect()] == [True] * 14
    ranked = t["ranked"].orderBy("rank").collect()
    assert [(r.name, r.total, r.tier, r.outreach_eligible) for r in ranked] == [
        ("HILL FORGE INC", 12, "Hot", True), ("Oak Mill", 10, "Hot", False)]
    assert ranked[0].lat == 42.2 and ranked[0].release_lbs == 2.0 and ranked[1].hold_reason == "citation under contest"
    assert {r.name: (r.n, r.national, r.rejected) for r in spark.read.parquet(str(work / "load_counts")).collect()} == {
        "raw_inspection": (4, 6, 0), "raw_violation": (4, 5, 1), "raw_emphasis_codes": (1, 1, 0), "raw_accident_injury": (1, 2, 0),
        "raw_accident": (1, 2, 0)}
    assert [(r.name, r.member, r.text) for r in spark.read.parquet(str(work / "rejects")).collect()] == [("violation", "part_0.csv", "1,2")]
    lines = [json.loads(x) for f in sorted((out / "leads_json").glob("*.json")) for x in f.read_text().splitlines()]
    assert [(x["name"], len(x["inspections"])) for x in lines] == [("Hill Forge Inc", 2), ("Oak Mill", 1)]
    assert t["new_hot"].count() == 0  # first run
    again = build.run(skip_load=True)  # same date again: still nothing to compare with
    assert again["new_hot"].count() == 0
    log = spark.read.parquet(str(out / "run_log")).collect()
    assert [(r.as_of, r.hot, r.match_year, r.checks_passed, len(r.loads)) for r in log] == [(date(2024, 6, 1), 2, 2024, 14, 5)]
    for name in ("summary", "top25", "by_state", "by_industry", "checks", "new_hot_leads"):
        assert list((out / "report" / name).glob("*.csv")), name
    # other dates: the latest twelve runs stay, in history and snapshots
    ranked = again["ranked"]
    for month in range(1, 16):
        fresh = build._delta(ranked.filter("total > 11") if month == 14 else ranked, F.lit(date(2025, 1, 1 + month)))
        assert [r.facility_id for r in fresh.collect()] == ([r.facility_id for r in ranked.filter("total <= 11").collect()] if month == 15 else [])
    for name in ("history", "snapshots"):
        days = [r.as_of for r in build.runs.read(name).select("as_of").distinct().collect()]
        assert sorted(days) == [date(2025, 1, 1 + m) for m in range(4, 16)]
    assert len(build.runs._commits()) == 2 and len(list((out / "runs").glob("snapshots-*"))) == 13  # of two commits
    # a run that stops between write and commit leaves the former state
    before = build.runs.state()
    monkeypatch.setattr(Store, "commit", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build._delta(ranked, F.lit(date(2025, 3, 1)))
    assert build.runs.state() == before and build.runs.read("history").filter("as_of = DATE '2025-03-01'").count() == 0


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, rows in members.items():
            z.writestr(f"{name}.csv", as_csv(["id", "x"], rows) + ("1,2,3\n" if name == "bad" else ""))


def test_only_changed_members_are_parsed(spark, tmp_path):
    store, glob = Store(spark, str(tmp_path / "store")), f"{tmp_path}/*.zip"

    def load(columns=("id", "x")):
        rows = incremental.load(spark, glob, list(columns), store, "t")
        good = rows.filter(F.col(archives.REJECT).isNull())
        assert incremental.counts(store, "t") == (good.count(), rows.count() - good.count())
        full = archives.read_archives(spark, glob, list(columns))
        assert sorted(map(str, good.select(*columns).collect())) == sorted(map(str, full.collect()))
        return {(r[archives.ARCHIVE].rsplit("/", 1)[1], r[archives.MEMBER][:-4]): r[incremental.LOAD]
                for r in rows.select(archives.ARCHIVE, archives.MEMBER, incremental.LOAD).distinct().collect()}

    zipped(tmp_path / "a.zip", p=[("1", "u"), ("2", "v")], q=[("3", "w")], none=[])
    zipped(tmp_path / "b.zip", bad=[("4", "x")])
    assert load() == {("a.zip", "p"): 1, ("a.zip", "q"): 1, ("b.zip", "bad"): 1}
    assert load() == load() and list(store.parts("t")) == ["1"]
    zipped(tmp_path / "a.zip", p=[("1", "u"), ("2", "v")], q=[("3", "other")])  # one member changed, one gone
    assert load() == {("a.zip", "p"): 1, ("a.zip", "q"): 2, ("b.zip", "bad"): 1}
    (tmp_path / "b.zip").unlink()
    zipped(tmp_path / "c.zip", r=[("9", "z")])
    assert load() == {("a.zip", "p"): 1, ("a.zip", "q"): 2, ("c.zip", "r"): 3}
    assert set(load(("x",)).values()) == {4}  # other columns: all anew
    assert list(store.parts("t")) == ["4"]


def test_many_loads_are_written_as_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "COMPACT", 2)
    store, glob = Store(spark, str(tmp_path / "store")), f"{tmp_path}/*.zip"
    for i in range(4):
        zipped(tmp_path / f"{i}.zip", m=[(str(i), "x")])
        rows = incremental.load(spark, glob, ["id"], store, "t")
        assert sorted(r.id for r in rows.collect()) == [str(j) for j in range(i + 1)]
    assert len(store.parts("t")) <= 2


def test_build_stops_on_failed_check(spark, tmp_path):
    from leadrank.operators import quality
    bad = spark.createDataFrame([(6, "facilities are in the territory and target industries", 1, False, "1 bad rows")],
                                "check_no int, check_name string, bad_rows long, passed boolean, detail string")
    with pytest.raises(RuntimeError):
        quality.require_passed(bad)
