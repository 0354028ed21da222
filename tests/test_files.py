"""Readers and writers on real folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from price_frames import day, price_frame
from daypanel import catalog
from daypanel.operators import panel
from daypanel.plans import report
from daypanel.sources import prices as price_source, snapshots, tickers, vendor, writers

HEADER = ("timestamp,open,high,low,close,adjusted_close,volume,dividend_amount,"
          "split_coefficient")


def vendor_line(day_text, price, volume):
    return f"{day_text},1,2,3,4,{price},{volume},0.0000,1.0000"


@pytest.fixture
def vendor_folder(tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    (folder / "AAPL.csv").write_text("\n".join(
        [HEADER, vendor_line("2018-03-02", "10.5", 100), vendor_line("2018-03-01", "10", 90)]) + "\n")
    (folder / "BRK.B.csv").write_text("\r\n".join(
        [HEADER, vendor_line("2018-03-01", "200.25", 7)]) + "\r\n")
    (folder / "LATE.csv").write_text('{\n  "Note": "call limit reached"\n}\n')
    return str(folder)


def test_vendor_folder_to_merged_table(spark, vendor_folder, tmp_path):
    target = str(tmp_path / "merged")
    writers.merge_vendor_folder(spark, vendor_folder, target)
    rows = [tuple(r) for r in price_source.read_prices(spark, target).orderBy("ticker", "day").collect()]
    assert rows == [("AAPL", day(1), 10.0, 90), ("AAPL", day(2), 10.5, 100),
                    ("BRK.B", day(1), 200.25, 7)]


def test_odd_ticker_names(spark, tmp_path):
    for name in ("^GSPC", "A+B", "X Y", "50%"):
        (tmp_path / f"{name}.csv").write_text(HEADER + "\n" + vendor_line("2018-03-01", 1, 1) + "\n")
    prices = vendor.to_prices(vendor.read_vendor_folder(spark, str(tmp_path)))
    assert sorted(r.ticker for r in prices.collect()) == ["50%", "A+B", "X Y", "^GSPC"]


def test_merge_is_skipped_when_the_target_exists(spark, vendor_folder, tmp_path):
    target = str(tmp_path / "merged")
    writers.write_prices(price_frame(spark, [("OLD", 1, 1)]), target)
    writers.merge_vendor_folder(spark, vendor_folder, target)
    assert [r.ticker for r in price_source.read_prices(spark, target).collect()] == ["OLD"]


def test_error_payloads_are_found_by_file(spark, vendor_folder):
    rejected = vendor.rejected_files(vendor.read_payload_lines(spark, vendor_folder)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in rejected] == ["LATE.csv"]


def test_error_payloads_in_rows(spark):
    answers = spark.createDataFrame([("A", "d,o\n1,2"), ("B", '{"Note": 1}')], "k string, payload string")
    assert [r.k for r in vendor.valid_payloads(answers).collect()] == ["A"]
    assert [r.k for r in vendor.rejected_payloads(answers).collect()] == ["B"]


def test_every_answer_is_valid_or_rejected(spark):
    answers = spark.createDataFrame([("A", "x"), ("B", "{"), ("C", None)], "k string, payload string")
    valid, rejected = (f(answers).collect() for f in (vendor.valid_payloads, vendor.rejected_payloads))
    assert [r.k for r in valid] == ["A"] and [r.k for r in rejected] == ["B", "C"]


def test_a_brace_on_one_line_removes_its_whole_file(spark):
    lines = spark.createDataFrame([("a", "1"), ("a", "x{"), ("b", "2"), ("b", "3")], "path string, line string")
    kept = vendor.without_rejected(lines, vendor.rejected_files(lines)).collect()
    assert sorted(r.line for r in kept) == ["2", "3"]


def strict_panels(spark, tmp_path):
    lines = spark.createDataFrame(
        [("d/A.csv", 0, HEADER), ("d/A.csv", 1, vendor_line("2018-03-01", "10", 1)), ("d/A.csv", 2, "2018-03-02,1,2"),
         ("d/A.csv", 3, vendor_line("x", "10", 1))], "path string, line_no int, line string")
    (tmp_path / "m.csv").write_text("A,2018-03-01,1.5,3\nB,2018-03-02,oops,3\n")
    return vendor.to_prices(vendor.vendor_rows(lines)), price_source.read_prices_csv(spark, str(tmp_path / "m.csv"))


@pytest.mark.parametrize("use", [
    lambda p: panel.filter_by_date(p, "2018-03-01", "2018-03-31"), lambda p: panel.filter_by_ticker(p, "Z"), panel.trading_days,
    panel.day_index, lambda p: p.select("ticker"), lambda p: p.where("volume > 100")])
def test_strict_reading_survives_pruning_and_filters(spark, tmp_path, use):
    for prices in strict_panels(spark, tmp_path):
        with pytest.raises(Exception, match="unreadable line"):
            use(prices).collect()


def test_an_unfinished_merge_is_done_again(spark, vendor_folder, tmp_path):
    target = tmp_path / "merged"
    (target / "_temporary").mkdir(parents=True)
    writers.merge_vendor_folder(spark, vendor_folder, str(target))
    assert price_source.read_prices(spark, str(target)).count() == 3


def test_merge_keeps_days_of_all_years_and_one_row_per_key_on_request(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    (folder / "A.csv").write_text("\n".join([HEADER] + [vendor_line(d, p, 1) for d, p in (
        ("1999-12-31", 1), ("2024-01-15", 2), ("2024-02-20", 3), ("2024-01-15", 4))]) + "\n")
    for duplicates, wanted in ((None, [1, 2, 3, 4]), ("first", [1, 2, 3]), ("last", [1, 3, 4])):
        target = str(tmp_path / f"merged-{duplicates}")
        writers.merge_vendor_folder(spark, str(folder), target, duplicates=duplicates)
        assert sorted(r.price for r in price_source.read_prices(spark, target).collect()) == wanted


def test_queries_keep_every_row_of_other_years(spark, tmp_path):
    events = [(1, u, t, float(i)) for i, (u, t) in enumerate(
        [(1, "1999-05-01 10:00:00"), (1, "2024-01-15 10:00:00"), (2, "2024-02-20 11:00:00")])]
    (spark.createDataFrame(events, "event_id long, user_id long, t string, value double")
     .selectExpr("event_id", "user_id", "cast(t as timestamp_ntz) ts", "value").write.parquet(str(tmp_path / "events.parquet")))
    assert catalog.ingest_vendor_files(spark, str(tmp_path)).count() == 3
    assert catalog.merge_prices(spark, str(tmp_path)).count() == 4  # the cut day is in both parts
    assert catalog.merge_prices_deduplicated(spark, str(tmp_path)).count() == 3


def test_bad_lines_stop_the_job_or_are_set_aside(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    (folder / "A.csv").write_text("\n".join(
        [HEADER, vendor_line("2018-03-01", "10", 1), "2018-03-02,1,2", vendor_line("2018-02-30", 1, 1),
         vendor_line("2018-03-05", "n/a", 1)]) + "\n")
    rows = vendor.read_vendor_folder(spark, str(folder))
    with pytest.raises(Exception, match="unreadable line"):
        vendor.to_prices(rows).collect()
    assert [r.day for r in vendor.to_prices(rows, strict=False).collect()] == [day(1)]
    assert sorted(r.c0 for r in vendor.malformed_rows(rows).collect()) == [
        "2018-02-30", "2018-03-02", "2018-03-05"]


def test_a_long_history_is_read_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    lines = [HEADER] + [vendor_line("2018-03-01", i, 1) for i in range(1, 20_001)]
    (folder / "LONG.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = vendor.to_prices(vendor.read_vendor_folder(spark, str(folder)))
        assert rows.select(F.spark_partition_id()).distinct().count() > 3
        assert rows.agg(F.count("*"), F.sum("price")).first()[:] == (20_000, 200_010_000.0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ticker_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text('"Symbol","Name"\n"AAPL", "Apple, Inc."\n MSFT ,Microsoft\n')
    found = tickers.read_ticker_list(spark, str(path))
    assert sorted(r.ticker for r in found.collect()) == ["AAPL", "MSFT"]
    lines = spark.createDataFrame([(0, '"Symbol"'), (1, ' "AAPL" ,x'), (2, "MSFT")],
                                  "line_no int, line string")
    assert sorted(r.ticker for r in tickers.ticker_list(lines).collect()) == ["AAPL", "MSFT"]


def test_headerless_csv_round_trip(spark, tmp_path):
    prices = price_frame(spark, [("A", 1, 10.125), ("B", 2, 3)])
    target = str(tmp_path / "csv")
    writers.write_prices_csv(prices, target, single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    back = price_source.read_prices_csv(spark, target)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, prices.collect()))
    with pytest.raises(Exception):
        writers.write_prices_csv(prices, target)


def test_bad_merged_line(spark, tmp_path):
    path = tmp_path / "merged.csv"
    path.write_text("A,2018-03-01,1.5,3\nB,2018-03-01,oops,3\n")
    with pytest.raises(Exception):
        price_source.read_prices_csv(spark, str(path)).collect()
    loose = price_source.read_prices_csv(spark, str(path), strict=False)
    assert [r.price for r in loose.orderBy("ticker").collect()] == [1.5, None]


def test_result_is_replaced_and_keeps_its_first_row(spark, tmp_path):
    target = str(tmp_path / "out")
    totals = spark.createDataFrame(
        [(1, day(2), 5.25), (2, day(2), 6.5), (1, day(1), 4.0)], "sim long, day date, total double")
    writers.write_result(totals.withColumn("total", F.lit(0.0)), target)
    writers.write_result(totals, target)
    table = report.sim_chart_table(report.read_result(spark, target))
    assert [tuple(r) for r in table.collect()] == [
        (1, day(1), 4.0), (1, day(2), 5.25), (2, day(2), 6.5)]
    tail = report.sim_chart_tail(report.read_result(spark, target), 2)
    assert [tuple(r) for r in tail.collect()] == [(2, day(2), 6.5), (1, day(2), 5.25)]


def test_snapshot_layout(spark, tmp_path):
    snapshot = spark.createDataFrame([(1, day(1), "A", 1.0, 2.0), (2, day(2), "A", 1.0, 2.0)],
                                     "sim long, day date, ticker string, price double, units double")
    writers.write_snapshot(snapshot, str(tmp_path / "snap"))
    assert sorted(p.name for p in (tmp_path / "snap").glob("day_key=*")) == ["day_key=20180301", "day_key=20180302"]
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 2


# -- years and days of stored tables ------------------------------------------

def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def years_of_prices(spark, years=range(2000, 2020)):
    rows = [("A", dt.date(y, m, 1), float(y), m) for y in years for m in (1, 7)]
    return spark.createDataFrame(rows, "ticker string, day date, price double, volume long")


def files_read(df) -> int:
    return df.select(F.input_file_name()).distinct().count()


@pytest.fixture
def stored_years(spark, tmp_path):
    path = str(tmp_path / "prices")
    writers.write_prices(years_of_prices(spark), path)
    return path


@pytest.mark.parametrize("cut", [
    lambda p: panel.filter_by_date(p, "2018-06-01", "2018-07-31"), lambda p: panel.prices_on_day(p, dt.date(2018, 7, 1)),
    lambda p: panel.filter_by_date(p.where("price > 0").select("day", "price"), dt.date(2018, 6, 1), "2018-07-31")])
def test_a_cut_to_days_opens_their_years_only(spark, stored_years, cut):
    rows = cut(price_source.read_prices(spark, stored_years))
    plan = plan_of(rows)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "2018" in plan.split("PartitionFilters")[1][:120]
    assert files_read(rows) == 1 and [(r.day, r.price) for r in rows.collect()] == [(dt.date(2018, 7, 1), 2018.0)]


def test_years_of_open_ranges(spark, stored_years):
    since = price_source.read_prices(spark, stored_years, start="2018-02-01")
    assert files_read(since) == 2 and since.count() == 3
    until = price_source.read_prices(spark, stored_years, end=dt.date(2000, 1, 1))
    assert files_read(until) == 1 and until.count() == 1
    assert price_source.read_prices(spark, stored_years).count() == 40
    assert price_source.read_prices(spark, stored_years).columns == ["ticker", "day", "price", "volume"]


def test_cuts_above_joins_aggregations_and_own_years(spark, stored_years):
    """Where the stored year is out of sight, or the caller has another one."""
    prices = price_source.read_prices(spark, stored_years)
    last = panel.dedupe_keep_last(prices, "volume")
    assert panel.filter_by_date(last, "2003-01-01", "2004-12-31").count() == 4
    fiscal = prices.withColumn("year", F.year("day") + 1)
    assert panel.filter_by_date(fiscal, "2003-01-01", "2004-12-31").count() == 4
    both = prices.join(prices.select("day", F.col("price").alias("other")), "day")
    assert panel.prices_on_day(both, "2005-01-01").count() == 1
    assert panel.filter_by_date(prices.unionByName(years_of_prices(spark)), "2005-01-01", "2005-12-31").count() == 4


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_an_update_rewrites_the_years_it_touches(spark, stored_years, tmp_path):
    before = files_of(tmp_path / "prices")
    update = spark.createDataFrame(
        [("A", dt.date(2010, 7, 1), 1.5, 9), ("B", dt.date(2010, 7, 1), 2.5, 9), ("A", dt.date(2030, 1, 1), 3.5, 9)],
        "ticker string, day date, price double, volume long").withColumn("extra", F.lit(1))
    for _ in range(2):  # once more changes nothing
        writers.update_prices(spark, stored_years, update)
        found = {(r.ticker, r.day): r.price for r in price_source.read_prices(spark, stored_years).collect()}
        want = {(r.ticker, r.day): r.price for r in years_of_prices(spark).collect()}
        assert found == want | {(r.ticker, r.day): r.price for r in update.collect()}
        assert price_source.read_prices(spark, stored_years).count() == len(found)
    after = files_of(tmp_path / "prices")
    same = {f for f in before if "year=2010" not in f}
    assert {f: after[f] for f in same} == {f: before[f] for f in same} and not set(before) - same & set(after)
    assert not (tmp_path / "prices" / "_update").exists()


def test_an_update_that_was_lost_is_finished(spark, stored_years, tmp_path):
    """The new year is written beside the table, and the old one is gone already."""
    staged = years_of_prices(spark, [2010]).withColumn("price", F.lit(7.0))
    writers.write_prices(staged, f"{stored_years}/_update")
    for f in (tmp_path / "prices" / "year=2010").iterdir():
        f.unlink()
    writers.update_prices(spark, stored_years, years_of_prices(spark, [2011]))
    found = price_source.read_prices(spark, stored_years)
    assert found.count() == 40 and {r.price for r in panel.filter_by_date(found, "2010-01-01", "2010-12-31").collect()} == {7.0}


def test_updates_that_are_no_upserts(spark, stored_years):
    twice = years_of_prices(spark, [2010, 2010])
    with pytest.raises(ValueError, match="two rows for A on 2010-"):
        writers.update_prices(spark, stored_years, twice)
    with pytest.raises(ValueError, match="a ticker and a day"):
        writers.update_prices(spark, stored_years, years_of_prices(spark, [2010]).withColumn("ticker", F.lit(None).cast("string")))
    writers.update_prices(spark, stored_years, twice.limit(0))
    assert price_source.read_prices(spark, stored_years).count() == 40


def test_a_new_download_updates_a_merged_table(spark, vendor_folder, tmp_path):
    target, new = str(tmp_path / "merged"), tmp_path / "new"
    writers.merge_vendor_folder(spark, vendor_folder, target)
    new.mkdir()
    (new / "AAPL.csv").write_text("\n".join([HEADER, vendor_line("2018-03-02", "11", 1), vendor_line("2019-01-02", "12", 1)]))
    writers.merge_vendor_folder(spark, str(new), target, update=True)
    rows = [tuple(r)[:3] for r in price_source.read_prices(spark, target).orderBy("ticker", "day").collect()]
    assert rows == [("AAPL", day(1), 10.0), ("AAPL", day(2), 11.0), ("AAPL", dt.date(2019, 1, 2), 12.0), ("BRK.B", day(1), 200.25)]


def test_a_retried_write_leaves_other_partitions(spark, stored_years, tmp_path):
    writers.write_prices(years_of_prices(spark, [2003]).withColumn("price", F.lit(1.0)), stored_years, mode="replace")
    rows = price_source.read_prices(spark, stored_years)
    assert rows.count() == 40 and rows.where("price = 1").count() == 2
    shot = spark.createDataFrame([(s, day(d), "A", 1.0, 2.0) for s in (1, 2) for d in (1, 2, 3)],
                                 "sim long, day date, ticker string, price double, units double")
    path = str(tmp_path / "snap")
    writers.write_snapshot(shot, path)
    for _ in range(2):
        writers.write_snapshot(shot.where("sim = 1").where(F.col("day") == day(2)).withColumn("units", F.lit(9.0)), path, mode="replace")
    assert sorted((r.sim, r.day.day, r.units) for r in snapshots.read_snapshot(spark, path).collect()) == [
        (1, 1, 2.0), (1, 2, 9.0), (1, 3, 2.0), (2, 1, 2.0), (2, 3, 2.0)]
    writers.write_snapshot(shot.where("sim = 1"), path)
    assert snapshots.read_snapshot(spark, path).count() == 3


def test_snapshots_are_read_by_day_and_scenario(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id % 300 sim", "date_add(date'2018-03-01', cast(id div 300 as int)) day", "'A' ticker",
                                        "1.0D price", "cast(id as double) units")
    path = str(tmp_path / "snap")
    writers.write_snapshot(rows, path)
    back = snapshots.read_snapshot(spark, path, day(3), "2018-03-04", [7, 8])
    assert [f.name for f in back.schema] == ["sim", "day", "ticker", "price", "units"]
    assert sorted(r.units for r in back.collect()) == [607.0, 608.0, 907.0, 908.0]
    plan = plan_of(back)
    assert "PartitionFilters: [isnotnull(day_key" in plan and "PushedFilters: [In(sim, [7,8])]" in plan
    assert files_read(back) == 2
    assert snapshots.read_snapshot(spark, path).count() == 3000


# -- one reading of a vendor folder -------------------------------------------

def test_a_merge_reads_the_folder_once(spark, vendor_folder, tmp_path, monkeypatch):
    reader, reads = type(spark.read), []
    for name in ("csv", "text"):
        original = getattr(reader, name)
        monkeypatch.setattr(reader, name, lambda self, path, _original=original, **more: (
            reads.append(path), _original(self, path, **more))[1])
    writers.merge_vendor_folder(spark, vendor_folder, str(tmp_path / "merged"), quarantine=str(tmp_path / "rejected"))
    assert reads == [vendor_folder]
    assert price_source.read_prices(spark, str(tmp_path / "merged")).count() == 3
    rejected = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert [(r.path.rsplit("/", 1)[1], r.reason, r.n_lines, r.line) for r in rejected] == [("LATE.csv", "error message", 2, "{")]


def test_rows_and_rejects_of_faulty_files(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    good = vendor_line("2018-03-01", "10", 1)
    (folder / "A.csv").write_text("\r\n".join([HEADER, "", good, "2018-03-02,1,2", vendor_line("2018-02-30", 1, 1)]) + "\r\n")
    (folder / "B.csv").write_text("\n".join([good, vendor_line("2018-03-04", 4, 4)]))  # its first line is taken for a header
    (folder / "C.csv").write_text("\n".join([HEADER, good, "x{"]))
    (folder / "EMPTY.csv").write_text("")
    (folder / "ticker=D%2FE").mkdir()
    (folder / "ticker=D%2FE" / "one.csv").write_text("\n".join([HEADER, good]))
    (folder / "ticker=D%2FE" / "two.csv").write_text("\n".join([HEADER, vendor_line("2018-03-09", 9, 9)]))
    (folder / "ticker=F").mkdir()
    (folder / "ticker=F" / "one.csv").write_text("\n".join([HEADER, good]))
    (folder / "ticker=F" / "two.csv").write_text('{"Note": 1}')
    target, rejects = str(tmp_path / "merged"), str(tmp_path / "rejected")
    with pytest.raises(Exception, match="unreadable line"):
        writers.merge_vendor_folder(spark, str(folder), target)
    writers.merge_vendor_folder(spark, str(folder), target, strict=False, quarantine=rejects)
    assert sorted((r.ticker, r.day.day) for r in price_source.read_prices(spark, target).collect()) == [
        ("A", 1), ("B", 4), ("D/E", 1), ("D/E", 9)]
    assert sorted((os.path.basename(r.path), r.reason, r.n_lines, r.line) for r in spark.read.parquet(rejects).collect()) == [
        ("A.csv", "unreadable line", 1, vendor_line("2018-02-30", 1, 1)), ("A.csv", "unreadable line", 1, "2018-03-02,1,2"),
        ("C.csv", "error message", 2, "x{"), ("ticker=F", "error message", 1, '{"Note": 1}')]


def test_written_vendor_files_come_back(spark, tmp_path):
    names = ["^GSPC", "A+B", "X Y", "50%", "a=b", "C/D", "PLAIN"]
    rows = price_frame(spark, [(n, d, i + d / 8) for i, n in enumerate(names) for d in (1, 2)])
    writers.write_vendor_folder(rows, str(tmp_path / "daily"))
    wanted = sorted(map(tuple, rows.collect()))
    assert sorted(map(tuple, vendor.to_prices(vendor.read_vendor_folder(spark, str(tmp_path / "daily"))).collect())) == wanted
    writers.merge_vendor_folder(spark, str(tmp_path / "daily"), str(tmp_path / "merged"))
    assert sorted(map(tuple, price_source.read_prices(spark, str(tmp_path / "merged")).collect())) == wanted


def test_a_long_file_is_one_verdict_of_many_tasks(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    lines = [HEADER] + [vendor_line("2018-03-01", i, 1) for i in range(1, 20_001)]
    (folder / "LONG.csv").write_text("\n".join(lines) + "\n")
    (folder / "BAD.csv").write_text("\n".join(lines) + "\n{\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        writers.merge_vendor_folder(spark, str(folder), str(tmp_path / "merged"), quarantine=str(tmp_path / "rejected"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert price_source.read_prices(spark, str(tmp_path / "merged")).agg(F.count("*"), F.sum("price")).first()[:] == (20_000, 200_010_000.0)
    assert [tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "rejected")).collect()] == [("error message", 20_001, "{")]


# -- folders of very many files -----------------------------------------------

def test_a_write_by_ticker_is_cut_by_files(spark, tmp_path):
    """Tickers of one line are little to shuffle and much to write."""
    rows = price_frame(spark, [(f"T{i}", 1, i) for i in range(12 * writers.FILES_PER_TASK)] + [(None, 1, 1.0)])
    laid = writers.by_ticker(rows)
    sizes = [r.n for r in laid.groupBy(F.spark_partition_id().alias("at")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 12 and max(sizes) < 2 * writers.FILES_PER_TASK
    assert sorted(map(str, laid.collect())) == sorted(map(str, rows.collect()))
    assert writers.by_ticker(rows.where("false")).count() == 0


def test_a_long_ticker_is_several_tasks_work(spark):
    rows = price_frame(spark, [("LONG", 1 + i % 28, i) for i in range(1000)] * 2 + [(f"T{i}", 1, 1.0) for i in range(50)])
    laid = writers.by_ticker(rows, lines_per_file=100)
    at = laid.withColumn("at", F.spark_partition_id())
    tasks = {r.ticker: r.n for r in at.groupBy("ticker").agg(F.count_distinct("at").alias("n")).collect()}
    assert tasks.pop("LONG") >= 5 and set(tasks.values()) == {1}
    assert sorted(map(tuple, laid.collect())) == sorted(map(tuple, rows.collect()))


def test_small_files_share_a_task(spark, tmp_path, monkeypatch):
    folder = tmp_path / "daily"
    folder.mkdir()
    for i in range(640):
        (folder / f"T{i}.csv").write_text("\n".join([HEADER, vendor_line("2018-03-01", i, 1)]))
    name, read, parts = "spark.sql.files.openCostInBytes", vendor.read_tagged_lines, []
    before = spark.conf.get(name)

    def counted(*given):
        lines = read(*given)
        parts.append(lines.rdd.getNumPartitions())
        return lines

    monkeypatch.setattr(vendor, "read_tagged_lines", counted)
    writers.merge_vendor_folder(spark, str(folder), str(tmp_path / "merged"))
    assert parts[0] <= 10  # twenty at Spark's own setting
    assert spark.conf.get(name) == before
    assert price_source.read_prices(spark, str(tmp_path / "merged")).agg(F.count("*"), F.sum("price")).first()[:] == (640, 640 * 639 / 2)
