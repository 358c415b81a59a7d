import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from greenledger.contracts import GOLD_SCHEMA
from greenledger.operators.usage import activity_factor_join, geo_fallback, usable_on
from greenledger.plans.ingest import SourceSpec, all_ok, run_sources
from greenledger.contracts import SERIES
from greenledger.sources.bronze import (
    find_column,
    find_column_prefix,
    land_bronze,
    normalise_sheet,
    scan_bronze,
    union_tagged_sheets,
)
from greenledger.sources.lookups import load_lookup
from greenledger.sources.publish import (
    check_schema,
    publish_snapshot,
    read_snapshot,
    reconcile_counts,
)
from tests.conftest import rows

D = dt.date


def test_land_and_scan_roundtrip_with_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([("2023", "1.5", "a,b \"q\""), ("2024", "2.5", "line\nbreak")],
                               "year string, co2_per_kWh string, factor_type string")
    land_bronze(df, tmp_dir, "nve")
    back = scan_bronze(spark, tmp_dir, "nve", ["year", "co2_per_kWh", "factor_type"])
    assert rows(back, "year", "co2_per_kWh", "factor_type") == [
        (2023, "1.5", 'a,b "q"'), (2024, "2.5", "line\nbreak")]
    # A re-run bringing only 2024 replaces 2024 and keeps 2023.
    land_bronze(spark.createDataFrame([("2024", "9.0", "m")], df.schema), tmp_dir, "nve")
    back = scan_bronze(spark, tmp_dir, "nve", ["year", "co2_per_kWh", "factor_type"])
    assert rows(back, "year", "co2_per_kWh") == [(2023, "1.5"), (2024, "9.0")]
    assert back.where("year = 2024").count() == 1


def test_publisher_layout_year_from_path(spark, tmp_dir):
    for year, val in (("2022", "3.0"), ("2023", "4.0")):
        os.makedirs(f"{tmp_dir}/nve/{year}")
        with open(f"{tmp_dir}/nve/{year}/factors.csv", "w", encoding="utf-8-sig") as f:
            f.write(f"co2_per_kWh,factor_type\n{val},Market-based\n")
    back = scan_bronze(spark, tmp_dir, "nve", ["co2_per_kWh", "factor_type"], layout="publisher")
    assert rows(back, "year", "co2_per_kWh") == [(2022, "3.0"), (2023, "4.0")]


def test_sheet_helpers(spark):
    df = spark.createDataFrame([(" År ", None), (None, None)], "` Aar ` string, ` CO2 ` string")
    norm = normalise_sheet(df)
    assert norm.columns == ["Aar", "CO2"] and norm.count() == 1
    assert find_column(["Year", " co2 "], "CO2") == " co2 "
    assert find_column(["Year"], "CO2") is None
    assert find_column_prefix(["ID", "GHG Conversion Factor 2024"], "GHG Conversion Factor") == \
        "GHG Conversion Factor 2024"


def test_union_tagged_sheets(spark):
    df = spark.createDataFrame(
        [("Varedeklarasjon 2024", 2024, 10.0), ("KLIMADEKLARASJON", 2024, 20.0), ("Notes", 2024, 0.0)],
        "sheet string, `YEAR` int, ` co2 ` double")
    out = union_tagged_sheets(df, "sheet", (("varedeklarasjon", "Market-based"),
                                            ("klimadeklarasjon", "Location-based")),
                              {"year": "year", "co2_per_kWh": "CO2"})
    assert rows(out) == [(2024, 10.0, "Market-based"), (2024, 20.0, "Location-based")]
    with pytest.raises(ValueError):
        union_tagged_sheets(df, "sheet", (), {"x": "missing"})


def test_load_lookup_empty_is_null(spark, tmp_dir):
    p = f"{tmp_dir}/t.csv"
    with open(p, "w") as f:
        f.write("factor_name_fr,factor_name_en,federation\nBallon,Ball,\n\"Sac, grand\",Bag,FOOT\n")
    lk = load_lookup(spark, p, spark.createDataFrame([], "factor_name_fr string, factor_name_en string, federation string").schema)
    assert rows(lk) == [("Ballon", "Ball", None), ("Sac, grand", "Bag", "FOOT")]


def gold(spark):
    return spark.createDataFrame(
        [("a", "defra", "Gas", None, 2.0, "kWh", "Scope 1", "Energy", "Fuel", "GLOBAL", 2024,
          D(2024, 1, 1), D(2024, 12, 31), True, 0.0)], GOLD_SCHEMA)


def test_publish_is_idempotent_and_reconciles(spark, tmp_dir):
    g = gold(spark)
    target = f"{tmp_dir}/gold"
    assert publish_snapshot(g, target) == 1
    held = read_snapshot(spark, target)
    first = rows(held)
    assert publish_snapshot(g, target) == 1
    assert rows(read_snapshot(spark, target)) == first == rows(held)  # a reader of the old version goes on
    r = reconcile_counts(g, read_snapshot(spark, target)).first()
    assert (r["src_rows"], r["dst_rows"], r["matched"]) == (1, 1, True)
    assert reconcile_counts(g, g.limit(0)).first()["matched"] is False
    publish_snapshot(g, target)
    assert len([p for p in os.listdir(target) if p.startswith("version-")]) == 2  # this one and the one before
    # A run that fails while writing leaves the published version as it was.
    with pytest.raises(Exception):
        publish_snapshot(g.withColumn("unit", F.raise_error(F.lit("boom")).cast("string")), target)
    assert rows(read_snapshot(spark, target)) == first


def test_check_schema(spark):
    check_schema(gold(spark))
    with pytest.raises(ValueError, match="missing is_current"):
        check_schema(gold(spark).drop("is_current"))
    with pytest.raises(ValueError, match="source_year"):
        check_schema(gold(spark).withColumn("source_year", F.col("source_year").cast("bigint")))


def test_run_sources_isolates_failures(spark, tmp_dir):
    good = spark.createDataFrame([("2024", "5.0", "Market-based")], "year string, co2_per_kWh string, factor_type string")
    bad = spark.createDataFrame([("2024", "-5.0", "Market-based")], good.schema)
    reg = {"ok_src": SourceSpec("ok_src", lambda s: good, SERIES),
           "bad_src": SourceSpec("bad_src", lambda s: bad, SERIES)}
    rep = run_sources(spark, reg, tmp_dir, ["ok_src", "bad_src", "nope"], max_parallel=3)
    assert [r["source"] for r in rep.collect()] == ["ok_src", "bad_src", "nope"]
    got = {r["source"]: (r["status"], r["reason"]) for r in rep.collect()}
    assert got["ok_src"] == ("ok", None)
    assert got["bad_src"][0] == "error" and "validation failed" in got["bad_src"][1]
    assert got["nope"] == ("error", "unknown_source")
    assert all_ok(rep).first()["ok"] is False
    assert os.path.isdir(f"{tmp_dir}/ok_src/year=2024") and not os.path.exists(f"{tmp_dir}/bad_src")


def test_usable_on_bounds(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 12, 31))], "ef_id string, valid_from date, valid_to date")
    assert usable_on(df, "2024-01-01").count() == 1
    assert usable_on(df, "2024-12-31").count() == 1
    assert usable_on(df, "2025-01-01").count() == 0


def test_activity_factor_join(spark):
    factors = spark.createDataFrame(
        [("f23", "Gas", "kWh", D(2023, 1, 1), D(2023, 12, 31), 2.0),
         ("f24", "Gas", "kWh", D(2024, 1, 1), D(2024, 12, 31), 3.0)],
        "ef_id string, factor_name string, unit string, valid_from date, valid_to date, gCO2e_per_unit double")
    act = spark.createDataFrame(
        [(1, "Gas", "kWh", D(2023, 6, 1), 10.0), (2, "Gas", "kWh", D(2024, 12, 31), 10.0),
         (3, "Gas", "kWh", D(2022, 6, 1), 10.0), (4, "Gas", "litres", D(2024, 6, 1), 10.0)],
        "a int, factor_name string, unit string, d date, qty double")
    out = activity_factor_join(act, factors, ["factor_name", "unit"], "d", "qty")
    assert rows(out, "a", "ef_id", "emissions") == [
        (1, "f23", 20.0), (2, "f24", 30.0), (3, None, None), (4, None, None)]


def test_geo_fallback_priority(spark):
    f = spark.createDataFrame([("NORWAY", 1.0), ("EUROPE", 2.0), ("GLOBAL", 3.0)],
                              "country_code string, gCO2e_per_unit double")
    act = spark.createDataFrame([(1, "NORWAY", "EUROPE"), (2, "FRANCE", "EUROPE"), (3, "PERU", "AMERICA")],
                                "a int, nation string, region string")
    out = geo_fallback(act, f, [("nation", "nation"), ("region", "region"), (None, "global", "GLOBAL")])
    assert rows(out, "a", "geo_level", "gCO2e_per_unit") == [
        (1, "nation", 1.0), (2, "region", 2.0), (3, "global", 3.0)]


def test_geo_fallback_rejects_a_repeated_code(spark):
    f = spark.createDataFrame([("NORWAY", 1.0), ("NORWAY", 2.0), ("GLOBAL", 3.0)], "country_code string, gCO2e_per_unit double")
    act = spark.createDataFrame([(1, "NORWAY")], "a int, nation string")
    with pytest.raises(ValueError, match="duplicate keys.*NORWAY"):
        geo_fallback(act, f, [("nation", "nation"), (None, "global", "GLOBAL")])


def test_publisher_files_are_bound_by_header_name(spark, tmp_dir):
    for year, text in (("2022", "year,co2_per_kWh,factor_type\n2022,19.0,Market-based\n"),
                       ("2023", "factor_type,year,co2_per_kWh\nLocation-based,2023,20.0\n"),
                       ("2024", "factor_type,co2_per_kWh\nMarket-based,21.0\n")):  # no year inside: the folder's
        os.makedirs(f"{tmp_dir}/nve/{year}")
        with open(f"{tmp_dir}/nve/{year}/factors.csv", "w") as f:
            f.write(text)
    back = scan_bronze(spark, tmp_dir, "nve", SERIES.names, layout="publisher")
    assert rows(back, "year", "co2_per_kWh", "factor_type") == [
        (2022, "19.0", "Market-based"), (2023, "20.0", "Location-based"), (2024, "21.0", "Market-based")]
    with open(f"{tmp_dir}/nve/2024/factors.csv", "w") as f:
        f.write("factor_type,year\nMarket-based,2024\n")
    with pytest.raises(ValueError, match="no column.*co2_per_kWh"):
        scan_bronze(spark, tmp_dir, "nve", SERIES.names, layout="publisher")


def test_arrivals_are_bound_by_header_name(spark, tmp_dir):
    from greenledger.streaming import land_arrivals, run_until_caught_up

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("factor_type,co2_per_kWh,year\nMarket-based,5.0,2024\n")
    run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/in", SERIES, f"{tmp_dir}/b", "nve"))
    back = scan_bronze(spark, f"{tmp_dir}/b", "nve", SERIES.names)
    assert rows(back, "year", "co2_per_kWh", "factor_type") == [(2024, "5.0", "Market-based")]
    with open(f"{tmp_dir}/in/b.csv", "w") as f:  # another order: fails, is not misread
        f.write("year,co2_per_kWh,factor_type\n2025,6.0,Market-based\n")
    with pytest.raises(Exception):
        run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/in", SERIES, f"{tmp_dir}/b", "nve"))
    assert scan_bronze(spark, f"{tmp_dir}/b", "nve", SERIES.names).count() == 1


def test_a_stream_that_is_not_done_raises(spark, tmp_dir):
    from greenledger.streaming import run_until_caught_up

    endless = spark.readStream.format("rate").load().writeStream.format("noop").option(
        "checkpointLocation", f"{tmp_dir}/ck").start()
    with pytest.raises(TimeoutError):
        run_until_caught_up([endless], timeout_s=2)
    assert not endless.isActive


def test_an_empty_message_does_not_stop_the_other_sources(spark, tmp_dir):
    good = spark.createDataFrame([("2024", "5.0", "m")], "year string, co2_per_kWh string, factor_type string")

    def silent(s):
        raise KeyError

    def long(s):
        raise ValueError("first\n" + "x" * 2000 + "\nlast")

    reg = {n: SourceSpec(n, f, SERIES) for n, f in (("a", silent), ("b", long), ("c", lambda s: good))}
    rep = {r["source"]: r for r in run_sources(spark, reg, tmp_dir).collect()}
    assert (rep["a"]["status"], rep["a"]["reason"]) == ("error", "KeyError")
    assert rep["b"]["reason"].endswith("\nlast") and len(rep["b"]["reason"]) > 2000
    assert rep["c"]["status"] == "ok"


def test_white_space_survives_csv(spark, tmp_dir):
    df = spark.createDataFrame([(" a\t", "k", "2024"), ("", "k", "2024"), (None, "k", "2024")], "v string, w string, year string")
    land_bronze(df, tmp_dir, "s")
    got = [r["v"] for r in scan_bronze(spark, tmp_dir, "s", ["v", "w", "year"]).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [" a\t", None, None]))  # CSV has no empty text beside NULL


def test_incremental_landing_lenient_and_strict(spark, tmp_dir):
    from greenledger.contracts import CATALOG
    from greenledger.streaming import land_arrivals, run_until_caught_up
    from greenledger.sources.bronze import CSV_OPTIONS

    cols = CATALOG.names
    good = ("a", "Fuels", "Gas", "Butane", None, None, "2.5", "kWh", "Scope 1", "kg CO2e", "2024")
    bad = ("b", "Fuels", "Gas", "Butane", None, None, "-1", "kWh", "Scope 1", "kg CO2e", "2024")
    schema = ", ".join(f"`{c}` string" for c in cols)
    spark.createDataFrame([good, bad], schema).write.options(**CSV_OPTIONS).csv(f"{tmp_dir}/in/1")
    run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/in", CATALOG, f"{tmp_dir}/bronze", "defra"))
    landed = scan_bronze(spark, f"{tmp_dir}/bronze", "defra", cols)
    assert rows(landed, "ID", "year") == [("a", 2024)]
    assert rows(spark.read.parquet(f"{tmp_dir}/bronze/_rejected/defra"), "ID") == [("b",)]
    # A second run sees only new files.
    spark.createDataFrame([("c",) + good[1:]], schema).write.options(**CSV_OPTIONS).csv(f"{tmp_dir}/in/2")
    run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/in", CATALOG, f"{tmp_dir}/bronze", "defra"))
    assert rows(scan_bronze(spark, f"{tmp_dir}/bronze", "defra", cols), "ID") == [("a",), ("c",)]

    # Strict contract: a batch with an invalid row fails and lands nothing.
    s_cols = SERIES.names
    spark.createDataFrame([("2024", "-1", "Market-based")], ", ".join(f"{c} string" for c in s_cols)) \
        .write.options(**CSV_OPTIONS).csv(f"{tmp_dir}/sin/1")
    with pytest.raises(Exception):
        run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/sin", SERIES, f"{tmp_dir}/sb", "nve",
                                          checkpoint=f"{tmp_dir}/ck"))
    assert not os.path.exists(f"{tmp_dir}/sb/nve")


def test_stream_counters_survive_a_replayed_batch(spark, tmp_dir):
    from greenledger.contracts import CATALOG
    from greenledger.operators.validate import validate
    from greenledger.sources.bronze import CSV_OPTIONS
    from greenledger.streaming import land_arrivals, landing_summary, run_until_caught_up

    schema = ", ".join(f"`{c}` string" for c in CATALOG.names)
    good = ("a", "Fuels", "Gas", "Butane", None, None, "2.5", "kWh", "Scope 1", "kg CO2e", "2024")
    bad, skipped = (*good[:6], "-1", *good[7:]), (*good[:6], None, *good[7:])
    every = []
    for k, part in enumerate(([good, bad, skipped], [good, good], [bad, bad, skipped, good])):
        spark.createDataFrame(part, schema).coalesce(1).write.options(**CSV_OPTIONS).csv(f"{tmp_dir}/in/{k}")
        every += part

    def run():
        run_until_caught_up(land_arrivals(spark, f"{tmp_dir}/in", CATALOG, f"{tmp_dir}/b", "defra", f"{tmp_dir}/ck", max_files_per_trigger=1))
        return landing_summary(spark, f"{tmp_dir}/b", "defra").first()

    want = validate(spark.createDataFrame(every, schema), CATALOG).summary().first()
    assert run() == want and (want["total"], want["valid"], want["invalid"], want["skipped"]) == (9, 4, 3, 2)
    assert sorted(p for p in os.listdir(f"{tmp_dir}/b/_counters/defra") if p.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    for name in ("2", ".2.crc"):  # the last batch was written, but its commit was lost
        os.remove(f"{tmp_dir}/ck/landing/commits/{name}")
    assert run() == want
    assert scan_bronze(spark, f"{tmp_dir}/b", "defra", CATALOG.names).count() == 4


def test_publisher_csv_and_prefixed_column(spark, tmp_dir):
    from greenledger.sources.bronze import read_publisher_csv, resolve_prefixed_column, year_slice

    p = f"{tmp_dir}/a.csv"
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("__id,GHG Conversion Factor 2024,Level 1\n1,2.5,Fuels\n")
    df = read_publisher_csv(spark, p)
    assert df.columns == ["__id", "GHG Conversion Factor 2024", "Level 1"]
    r = resolve_prefixed_column(df, "GHG Conversion Factor", "GHG Conversion Factor")
    assert r.first()["GHG Conversion Factor"] == "2.5"
    e = resolve_prefixed_column(df.drop("GHG Conversion Factor 2024"), "GHG Conversion Factor",
                                "GHG Conversion Factor")
    assert e.count() == 0 and "GHG Conversion Factor" in e.columns
    with pytest.raises(ValueError):
        resolve_prefixed_column(df.drop("GHG Conversion Factor 2024"), "GHG", "x", on_missing="fail")
    empty = f"{tmp_dir}/empty.csv"
    open(empty, "w").close()
    with pytest.raises(Exception):
        read_publisher_csv(spark, empty)
    ys = spark.createDataFrame([(2023,), (2024,)], "year int")
    assert rows(year_slice(ys, 2024)) == [(2024,)]


def test_default_edition_year():
    from greenledger.plans.staging import default_edition_year
    assert default_edition_year(D(2026, 3, 1)) == 2025


def test_strict_ingest_is_all_or_nothing(spark, tmp_dir):
    from greenledger.operators.validate import ContractError
    from greenledger.plans.ingest import ingest_source

    schema = "year string, co2_per_kWh string, factor_type string"
    good = spark.createDataFrame([("2024", "5.0", "Market-based"), ("2023", "4.0", "Market-based")], schema)
    ingest_source(spark, SourceSpec("nve", lambda s: good, SERIES), tmp_dir)
    assert rows(scan_bronze(spark, tmp_dir, "nve", SERIES.names), "year", "co2_per_kWh") == \
        [(2023, "4.0"), (2024, "5.0")]
    # A later batch for 2024 with one invalid row lands nothing.
    bad = spark.createDataFrame([("2024", "6.0", "Market-based"), ("2024", "-1", "Market-based")], schema)
    with pytest.raises(ContractError):
        ingest_source(spark, SourceSpec("nve", lambda s: bad, SERIES), tmp_dir)
    assert rows(scan_bronze(spark, tmp_dir, "nve", SERIES.names), "year", "co2_per_kWh") == \
        [(2023, "4.0"), (2024, "5.0")]
    assert not [p for p in os.listdir(tmp_dir) if p.startswith("_staging")]
    # A valid 2024 batch replaces 2024 only.
    newer = spark.createDataFrame([("2024", "6.0", "Market-based")], schema)
    ingest_source(spark, SourceSpec("nve", lambda s: newer, SERIES), tmp_dir)
    assert rows(scan_bronze(spark, tmp_dir, "nve", SERIES.names), "year", "co2_per_kWh") == \
        [(2023, "4.0"), (2024, "6.0")]


def test_land_bronze_without_aqe_uses_hash_buckets(spark, tmp_dir):
    df = spark.createDataFrame([(str(2020 + i % 3), str(i), "t") for i in range(50)],
                               "year string, co2_per_kWh string, factor_type string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        land_bronze(df, tmp_dir, "nve", files_per_year=4)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    back = scan_bronze(spark, tmp_dir, "nve", ["year", "co2_per_kWh", "factor_type"])
    assert back.count() == 50
    assert sorted(p for p in os.listdir(tmp_dir + "/nve") if p.startswith("year=")) == \
        ["year=2020", "year=2021", "year=2022"]
    assert all(len([f for f in os.listdir(f"{tmp_dir}/nve/year={y}") if f.endswith(".csv")]) <= 4
               for y in (2020, 2021, 2022))


def test_intermediate_tables_can_be_cleaned_up(spark):
    from greenledger import tables

    app = spark.sparkContext.applicationId
    before, named = tables._MADE.pop(app, []), tables._NAMED.pop(app, [])  # those of other tests stay
    try:
        kept = tables.written(spark.range(5), "cleaned")
        (path,) = tables._MADE[app]
        assert kept.count() == 5 and os.path.isdir(path)
        spark.range(3).write.option("path", tables.fresh_path(spark, "named")).saveAsTable(tables.named_table(spark, "gl_cleaned"))
        assert spark.catalog.tableExists("gl_cleaned")
        assert tables.clean_up(spark) == 2 and not os.path.exists(path) and tables.clean_up(spark) == 0
        assert not spark.catalog.tableExists("gl_cleaned")
    finally:
        tables._MADE[app], tables._NAMED[app] = before, named


def test_entry_survives_a_missing_optional_package():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e\n"
            "from greenledger.plans.queries import QUERIES\n"
            "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES)")
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    if os.path.isdir(os.path.join(root, "greenledger", "llm")):
        assert "left out" in run.stderr
