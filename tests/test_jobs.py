import gzip
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.types import DIFFERENCE_COLUMNS
from ledgerloom.plans import database, export, feeds, gl_daily, recon_daily
from ledgerloom.queries.ledger import RULES, RULES_SCHEMA
from ledgerloom.sources import batch_ids, files, jdbc, published, workdir
from ledgerloom.sources.layouts import EXPORT_SHORT, dated_path, family_patterns
from test_dirty import BALANCE, feed_line, line, lines

MASTER = "CGL_NUMBER string, BAL_COMPARE int"


def master(spark):
    return spark.createDataFrame([("1000000000", 1), ("1000000000", 1)], MASTER)


def day_lines(spark, *amounts):
    fields = [f"{a:016d}" + "0" if a >= 0 else f"{-a:016d}" + "p" for a in amounts]
    return lines(spark, *[line(local=f) for f in fields])


def closing(spark, path):
    return {str(r.BALANCE_DATE): r.BALANCE for r in published.read_days(spark, path, "BALANCE_DATE").collect()}


def test_gl_days_and_rerun(spark, tmp_path):
    tables = gl_daily.GlTables(str(tmp_path / "txn"), str(tmp_path / "bal"))
    run = lambda amounts, day, before: gl_daily.run_gl_day(
        spark, day_lines(spark, *amounts), master(spark), tables, day, "1", before
    )
    run([500, -200], "2025-01-01", None)
    run([100], "2025-01-02", "2025-01-01")
    assert closing(spark, tables.balances) == {"2025-01-01": 3, "2025-01-02": 4}
    run([700], "2025-01-02", "2025-01-01")  # the day again, with other input
    assert closing(spark, tables.balances) == {"2025-01-01": 3, "2025-01-02": 10}
    posted = published.read_days(spark, tables.transactions, "POST_DAY")
    assert posted.count() == 2
    with pytest.raises(ValueError, match="no balances for 2024-12-31"):
        run([1], "2025-01-03", "2024-12-31")
    for table, column in [(tables.transactions, "POST_DAY"), (tables.balances, "BALANCE_DATE")]:
        assert published.read_day(spark, table, column, "2025-01-03") is None


def test_backfill(spark, tmp_path):
    tables = gl_daily.GlTables(str(tmp_path / "txn"), str(tmp_path / "bal"))
    amounts = {"2025-01-01": [500], "2025-01-02": [100, 100], "2025-01-03": [-900]}
    gl_daily.run_backfill(
        spark, lambda day: day_lines(spark, *amounts[day]), master(spark), tables, amounts
    )
    assert closing(spark, tables.balances) == {"2025-01-01": 5, "2025-01-02": 7, "2025-01-03": -2}


def test_feeds_job(spark, tmp_path):
    sources = {
        "INV": lines(spark, feed_line("INV", "1000", "+")),
        "BOR": lines(spark, feed_line("BOR", "500", "-")),
        "GLCC": lines(spark, feed_line("GLCC", "25", "+"), feed_line("GLCC", "x", "+")),
    }
    table = str(tmp_path / "cbs")
    feeds.run_feeds(spark, sources, table, "2025-01-01", None)
    with pytest.raises(ValueError, match="no balances for 2024-12-31"):
        feeds.run_feeds(spark, sources, table, "2025-01-02", "2024-12-31")
    row = published.read_day(spark, table, "BALANCE_DATE", "2025-01-01").first()
    assert (row.BRANCH_CODE, row.CURRENCY, row.CGL) == ("00001", "INR", "1000000000")
    assert row.BALANCE == D("0.5025")
    # of all days that the table holds, the stated one is rolled forward
    for day, before in [("2025-01-02", "2025-01-01"), ("2025-01-03", "2025-01-02"), ("2025-01-03", "2025-01-02")]:
        feeds.run_feeds(spark, sources, table, day, before)
    assert sorted(closing(spark, table).values()) == [D("0.5025"), D("1.0050"), D("1.5075")]


def ledger(spark, balances, day):
    rows = [("B", "INR", k, D(v)) for k, v in balances.items()]
    return spark.createDataFrame(rows, BALANCE).withColumn("BALANCE_DATE", F.lit(day).cast("date"))


@pytest.mark.parametrize("rules", [False, True])
def test_recon_job(spark, tmp_path, rules):
    table = str(tmp_path / "diff")
    days = ["2025-01-01", "2025-01-02"]
    cbs = ledger(spark, {"5": "1", "1": "2"}, days[0]).union(ledger(spark, {"5": "1", "1": "5"}, days[1]))
    gl = ledger(spark, {"5": "1", "1": "3"}, days[0]).union(ledger(spark, {"5": "9", "1": "3"}, days[1]))
    rule_table = spark.createDataFrame(RULES, RULES_SCHEMA) if rules else None
    history = spark.createDataFrame(
        [], "RECON_RUN_DATE timestamp, BRANCH_CODE string, CURRENCY string, CGL string, "
        "DIFFERENCE_AMOUNT decimal(20,4)"
    )
    for before, day in [("2024-12-31", days[0]), (days[0], days[1]), (days[0], days[1])]:
        recon_daily.run_recon(
            table, day, cbs=cbs, gl=gl, history=history, previous_date=before, rules=rule_table,
            run_time=F.lit(f"{day} 07:30:00").cast("timestamp"),
        )
        history = published.read_days(spark, table, "RECON_DAY")
    assert history.columns == [*DIFFERENCE_COLUMNS, "RECON_DAY"]
    found = {(str(r.RECON_DAY), r.CGL): (r.DIFFERENCE_AMOUNT, r.DIFF_BW_YESTERDAY, r.TYPE, r.HEAD) for r in history.collect()}
    assert found == {
        (days[0], "1"): (-1, -1, "New Entry", "LOAN"),
        (days[1], "1"): (2, 3, "Changed", "LOAN"),
        (days[1], "5"): (-8, -8, "New Entry", "MEMO"),
    }


def test_a_day_that_becomes_empty(spark, tmp_path):
    table = str(tmp_path / "days")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").withColumn("DAY", F.lit("2025-01-01").cast("date"))
    assert published.write_day(rows.limit(0), table, "DAY", "2025-01-01") == 0
    assert published.write_day(rows, table, "DAY", "2025-01-01") == 2
    assert published.write_day(rows.limit(0), table, "DAY", "2025-01-01", append=True) == 0
    assert published.read_days(spark, table, "DAY").count() == 2
    assert published.write_day(rows.limit(0), table, "DAY", "2025-01-01") == 0
    assert published.read_days(spark, table, "DAY").count() == 0
    assert published.read_day(spark, table, "DAY", "2025-01-02") is None


def test_a_write_that_does_not_add_up_leaves_the_old_day(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "days")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").withColumn("DAY", F.lit("2025-01-01").cast("date"))
    published.write_day(rows, table, "DAY", "2025-01-01")

    def read():
        return sorted((str(r.DAY), r.k, r.v) for r in published.read_days(spark, table, "DAY").collect())

    old = read()
    other = rows.withColumn("v", F.col("v") + 10)
    wrong_day = other.withColumn("DAY", F.lit("2025-01-02").cast("date"))
    for bad in (wrong_day, other.union(wrong_day), other.withColumn("DAY", F.lit(None).cast("date"))):
        with pytest.raises(RuntimeError, match="nothing is published"):
            published.write_day(bad, table, "DAY", "2025-01-01")
        assert read() == old
    with monkeypatch.context() as patch:  # rows are lost between the write and the reader
        patch.setattr(published, "_rows_by_day", lambda *a: {"2025-01-01": 1})
        with pytest.raises(RuntimeError, match="nothing is published"):
            published.write_day(other, table, "DAY", "2025-01-01")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):  # the write itself fails
        published.write_day(other.withColumn("v", F.expr("cast(1 div (v - 12) as int)")), table, "DAY", "2025-01-01")
    assert read() == old and published.superseded(spark, table, "DAY") == []
    published.write_day(other, table, "DAY", "2025-01-01")
    assert [v for _, _, v in read()] == [11, 12] and len(published.superseded(spark, table, "DAY")) == 1


def test_days_change_together(spark, tmp_path):
    table, days = str(tmp_path / "days"), ["2025-01-01", "2025-01-02", "2025-01-03"]
    rows = spark.createDataFrame([(days[0], 1), (days[0], 2), (days[2], 3)], "DAY string, v int").withColumn("DAY", F.col("DAY").cast("date"))
    assert published.write_days(rows, table, "DAY", days) == {days[0]: 2, days[1]: 0, days[2]: 1}
    assert published.published_days(spark, table) == {days[0]: 2, days[1]: 0, days[2]: 1}
    published.write_days(rows.filter("v <> 2"), table, "DAY", [days[0], days[2]], append=True)
    assert published.published_days(spark, table) == {days[0]: 3, days[1]: 0, days[2]: 2}
    assert published.read_days(spark, table, "DAY", [days[0], days[1]]).count() == 3
    assert published.read_days(spark, table, "DAY", ["2024-01-01"]) is None
    assert dict(published.read_days(spark, table, "DAY").dtypes) == {"v": "int", "DAY": "date"}


def test_rejects_are_published_or_stop_the_day(spark, tmp_path):
    tables = gl_daily.GlTables(*(str(tmp_path / t) for t in ("txn", "bal", "rejects")))
    good, bad = line(local="0000000000001000" + "0"), line(local="0000000000009000}")
    data = lines(spark, good, bad, bad, line(local=" " * 17), good)
    with pytest.raises(ValueError, match="3 lines rejected, at most 2"):
        gl_daily.run_gl_day(spark, data, master(spark), tables, "2025-01-01", "1", None, most_rejects=2)
    assert all(published.published_days(spark, t) == {} for t in tables)
    gl_daily.run_gl_day(spark, data, master(spark), tables, "2025-01-01", "1", None, most_rejects=3)
    rejects = published.read_day(spark, tables.rejects, "POST_DAY", "2025-01-01").collect()
    assert sorted((r.value, r.LINES) for r in rejects) == sorted([(bad, 2), (line(local=" " * 17), 1)])
    posted = published.read_day(spark, tables.transactions, "POST_DAY", "2025-01-01").collect()
    assert [(r.TRANSACTION_COUNT, r.DEBIT_AMOUNT) for r in posted] == [(5, 20)]
    assert closing(spark, tables.balances) == {"2025-01-01": 20}
    # the same transactions as without a table of rejects
    plain = gl_daily.GlTables(str(tmp_path / "txn2"), str(tmp_path / "bal2"))
    gl_daily.run_gl_day(spark, data, master(spark), plain, "2025-01-01", "1", None)
    assert published.read_days(spark, plain.transactions, "POST_DAY").collect() == posted


def test_rejects_and_totals_share_one_scan(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([line(local="0000000000001000" + "0"), line(local="0000000000009000}")]))
    seen = spark.sparkContext.accumulator(0)
    data = spark.read.text(str(tmp_path / "in"))

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    tables = gl_daily.GlTables(*(str(tmp_path / t) for t in ("txn", "bal", "rejects")))
    gl_daily.run_gl_day(spark, data.mapInArrow(count, "value string"), master(spark), tables, "2025-01-01", "1", None, most_rejects=9)
    assert seen.value == 2


def test_a_corrected_day_reaches_all_later_balances(spark, tmp_path):
    days = ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-05"]

    def posted(*rows):
        return lines(spark, *[line(key=k, local=f"{a:016d}0") for k, a in rows])

    a, b, c, d = ("00001INR1000000000", "00002INR1000000000", "00003INR1000000000", "00004INR1000000000")
    amounts = {days[0]: [(a, 100)], days[1]: [(a, 5), (b, 7), (d, 1)], days[2]: [(a, 1)], days[3]: [(b, 2)]}
    corrected = {**amounts, days[1]: [(a, 50), (c, 3)]}  # b comes only on the last day then, d never

    def backfill(name, amounts):
        tables = gl_daily.GlTables(str(tmp_path / f"{name}-txn"), str(tmp_path / f"{name}-bal"))
        gl_daily.run_backfill(spark, lambda day: posted(*amounts[day]), master(spark), tables, days)
        return tables

    def rows(tables):
        found = published.read_days(spark, tables.balances, "BALANCE_DATE").collect()
        return sorted((str(r.BALANCE_DATE), r.BRANCH_CODE, r.CURRENCY, r.CGL, r.BALANCE) for r in found)

    tables, want = backfill("mine", amounts), backfill("want", corrected)
    assert rows(tables) != rows(want)
    for _ in range(2):  # again changes nothing
        restated = gl_daily.restate_gl_day(spark, posted(*corrected[days[1]]), master(spark), tables, days[1], "9")
        assert restated == days[1:] and rows(tables) == rows(want)
    first = gl_daily.restate_gl_day(spark, posted((a, 1)), master(spark), tables, days[0], "10")
    assert first == days and ("2025-01-01", "00001", "INR", "1000000000", D("0.01")) in rows(tables)
    with pytest.raises(ValueError, match="no balances for 2025-01-04"):
        gl_daily.restate_gl_day(spark, posted((a, 1)), master(spark), tables, "2025-01-04", "11")


def test_recon_stamped_on_the_next_morning(spark, tmp_path):
    table, days = str(tmp_path / "diff"), ["2025-01-01", "2025-01-02"]
    cbs = ledger(spark, {"5": "1"}, days[0]).union(ledger(spark, {"5": "1"}, days[1]))
    gl = ledger(spark, {"5": "4"}, days[0]).union(ledger(spark, {"5": "4"}, days[1]))
    history = spark.createDataFrame(
        [], "RECON_RUN_DATE timestamp, BRANCH_CODE string, CURRENCY string, CGL string, "
        "DIFFERENCE_AMOUNT decimal(20,4)"
    )

    def run(day, before, stamp, gl):
        recon_daily.run_recon(
            table, day, cbs=cbs, gl=gl, history=history, previous_date=before,
            run_time=F.lit(f"{stamp} 07:30:00").cast("timestamp"),
        )

    run(days[0], "2024-12-31", days[1], gl)
    history = published.read_days(spark, table, "RECON_DAY")
    run(days[1], days[0], "2025-01-03", gl)
    found = {str(r.RECON_DAY): r.TYPE for r in published.read_days(spark, table, "RECON_DAY").collect()}
    assert found == {days[0]: "New Entry", days[1]: "Unchanged"}
    # corrected so that no difference is left, and run again
    run(days[1], days[0], "2025-01-03", cbs)
    assert {str(r.RECON_DAY) for r in published.read_days(spark, table, "RECON_DAY").collect()} == {days[0]}


def test_exports(spark, tmp_path):
    data = day_lines(spark, 1, 2, 3)
    full, daily = str(tmp_path / "full"), str(tmp_path / "daily")
    export.run_full_export(data, full, max_records=1)
    assert len(spark.read.parquet(full).columns) == 13
    assert export.run_daily_export(data, daily, "2025-01-01") == 3
    export.run_daily_export(data, daily, "2025-01-02", append=True)
    export.run_daily_export(data, daily, "2025-01-02", append=True)
    export.run_daily_export(data, daily, "2025-01-01")
    counts = published.published_days(spark, daily)
    assert counts == {"2025-01-01": 3, "2025-01-02": 6}
    assert [f.name for f in EXPORT_SHORT] == ["txdate", "journal", "branch", "currency", "GLCC", "lcyAmt", "fcyAmt"]


def test_paths_and_work_folder(spark):
    assert dated_path("base/", "2025-01-01", "in", "*.gz") == "base/2025-01-01/in/*.gz"
    assert workdir.new_folder(spark, "x") != workdir.new_folder(spark, "x")
    assert workdir.new_folder(spark, "x").startswith(workdir.shared_folder(spark))


def test_work_folder_without_the_setting(tmp_path, monkeypatch):
    def session(master, folder=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder),
            sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
        )

    monkeypatch.setattr(workdir.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    assert workdir.shared_folder(session("local[2]")) == str(tmp_path)
    assert workdir.shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workdir.shared_folder(session("yarn"))


# --- database jobs: the tables are a dict here, since no database may be started.


@pytest.fixture
def tables(spark, monkeypatch):
    stored = {}

    def append(df, db, table, **options):
        stored.setdefault("appended", []).append(table)
        if stored.get("fails") == (table, stored["appended"].count(table)):
            part = df.limit(stored["fails_after"])
            stored[table] = spark.createDataFrame(stored[table].unionByName(part.select(*stored[table].columns)).collect(), stored[table].schema)
            raise RuntimeError("connection lost")
        rows = stored[table].unionByName(df.select(*stored[table].columns))
        stored[table] = spark.createDataFrame(rows.collect(), rows.schema)

    def read_table(spark, db, table, split=None):
        stored.setdefault("splits", {})[table] = split
        return stored[table]

    monkeypatch.setattr(jdbc, "read_table", read_table)
    monkeypatch.setattr(jdbc, "append", append)
    return stored


DB = jdbc.Database("jdbc:test:", "none", "me", "secret", {"connectTimeout": "60"})


def test_database_jobs(spark, tables):
    transactions = gl_daily.transactions_of(day_lines(spark, 1), master(spark), "2025-01-01", "1")
    names = database.TableNames()
    balance = ledger(spark, {}, "2025-01-01")
    tables[names.transactions] = transactions.limit(0)
    tables[names.gl_balance] = tables[names.cbs_balance] = balance
    tables[names.master] = master(spark)
    tables[names.rules] = spark.createDataFrame(RULES, RULES_SCHEMA)
    tables[names.batches] = spark.createDataFrame([], database.BATCH_SCHEMA)

    database.run_gl_day(spark, DB, day_lines(spark, 500), "2025-01-01", 7, None)
    database.run_gl_day(spark, DB, day_lines(spark, 100), "2025-01-02", 8, "2025-01-01")
    assert [r.BALANCE for r in tables[names.gl_balance].orderBy("BALANCE_DATE").collect()] == [5, 6]
    assert {r.BATCH_ID for r in tables[names.transactions].collect()} == {"7", "8"}
    with pytest.raises(ValueError, match="batch 8 is already there"):
        database.run_gl_day(spark, DB, day_lines(spark, 100), "2025-01-03", 8, "2025-01-02")
    with pytest.raises(ValueError, match="balance of 2025-01-02 is already there"):
        database.run_gl_day(spark, DB, day_lines(spark, 100), "2025-01-02", 9, "2025-01-01")
    with pytest.raises(ValueError, match="no balances"):
        database.run_gl_day(spark, DB, day_lines(spark, 100), "2025-01-04", 9, "2025-01-03")

    feed = {"INV": lines(spark, feed_line("INV", "4000", "+"))}
    split = jdbc.Split("BALANCE_DATE", "2025-01-01", "2026-01-01", 8)
    database.run_feeds(spark, DB, feed, "2025-01-02", None, splits={names.cbs_balance: split})
    assert tables["splits"][names.cbs_balance] == split and tables["splits"][names.gl_balance] is None
    tables[names.differences] = spark.createDataFrame(
        [], "RECON_RUN_DATE timestamp, BRANCH_CODE string, CURRENCY string, CGL string, "
        "CBS_BALANCE decimal(38,8), GL_BALANCE decimal(38,3), DIFFERENCE_AMOUNT decimal(20,4), "
        "DIFF_BW_YESTERDAY decimal(20,4), TYPE string, HEAD string, RECON_DAY date"
    )
    now = F.lit("2025-01-02 08:00:00").cast("timestamp")
    database.run_recon(spark, DB, "2025-01-02", "2025-01-01", now)
    row = tables[names.differences].first()
    assert (row.DIFFERENCE_AMOUNT, row.TYPE, row.HEAD) == (-2, "New Entry", "LOAN")
    with pytest.raises(ValueError, match="already there"):
        database.run_recon(spark, DB, "2025-01-02", "2025-01-01", now)


def test_database_recon_by_the_day_compared(spark, tables):
    """Day 1 is stamped on the morning of day 2, as a run after midnight is."""
    names, days = database.TableNames(), ["2025-01-01", "2025-01-02"]
    tables[names.cbs_balance] = ledger(spark, {"5": "1"}, days[0]).union(ledger(spark, {"5": "1"}, days[1]))
    tables[names.gl_balance] = ledger(spark, {"5": "4"}, days[0]).union(ledger(spark, {"5": "4"}, days[1]))
    plain = (
        "RECON_RUN_DATE timestamp, BRANCH_CODE string, CURRENCY string, CGL string, CBS_BALANCE decimal(38,8), "
        "GL_BALANCE decimal(38,3), DIFFERENCE_AMOUNT decimal(20,4), DIFF_BW_YESTERDAY decimal(20,4), TYPE string, HEAD string"
    )
    tables[names.differences] = spark.createDataFrame([], plain)

    def run(day, before, stamp):
        now = F.lit(f"{stamp} 07:30:00").cast("timestamp")
        database.run_recon(spark, DB, day, before, now, by_rules=False)

    with pytest.raises(ValueError, match="needs a column RECON_DAY"):
        run(days[0], "2024-12-31", days[1])
    tables[names.differences] = spark.createDataFrame([], plain + ", RECON_DAY date")
    run(days[0], "2024-12-31", days[1])
    run(days[1], days[0], "2025-01-03")
    for day, before in zip(days, ["2024-12-31", days[0]]):
        with pytest.raises(ValueError, match=f"run of {day} is already there"):
            run(day, before, "2025-01-04")
    found = {str(r.RECON_DAY): (r.TYPE, r.DIFF_BW_YESTERDAY) for r in tables[names.differences].collect()}
    assert found == {days[0]: ("New Entry", -3), days[1]: ("Unchanged", 0)}


@pytest.mark.parametrize("table", ["transactions", "gl_balance", "batches"])
@pytest.mark.parametrize("after", [0, 2])
def test_a_batch_that_died_is_finished(spark, tables, table, after):
    names = database.TableNames()

    def data(extra=0):
        keys = [f"0000{i}INR1000000000" for i in range(1, 6)]
        return lines(spark, *[line(key=k, local=f"{100 * i + extra:016d}0") for i, k in enumerate(keys)])

    def empty():
        tables[names.transactions] = gl_daily.transactions_of(data(), master(spark), "2025-01-01", "1").limit(0)
        tables[names.gl_balance] = ledger(spark, {}, "2025-01-01")
        tables[names.master] = master(spark)
        tables[names.batches] = spark.createDataFrame([], database.BATCH_SCHEMA)
        tables["appended"] = []

    def run(extra=0):
        database.run_gl_day(spark, DB, data(extra), "2025-01-01", 7, None)

    def rows():
        return [sorted(map(str, tables[t].collect())) for t in (names.transactions, names.gl_balance, names.batches)]

    empty()
    run()
    want = rows()
    for turn in [1, 2, 3] if table == "batches" else [1]:
        empty()
        tables["fails"], tables["fails_after"] = (getattr(names, table), turn), after
        with pytest.raises(RuntimeError, match="connection lost"):
            run()
        del tables["fails"]
        states = {r.STATE for r in tables[names.batches].collect()}
        if rows()[0] and database.POSTED not in states:  # other input for a batch that is partly there
            with pytest.raises(ValueError, match="does not give"):
                run(extra=1)
        if want == rows():  # the last mark was made, the call that made it failed
            continue
        run(extra=database.POSTED in states)
        assert [sorted(set(r)) if i == 2 else r for i, r in enumerate(rows())] == want, turn
        with pytest.raises(ValueError, match="batch 7 is already there"):
            run()
        with pytest.raises(ValueError, match="batch 7 of 2025-01-01"):
            database.run_gl_day(spark, DB, data(), "2025-01-01", 8, None)


def test_jdbc_options():
    split = jdbc.Split("id", "1", "100", 8)
    assert jdbc.read_options(DB, "(select 1) T1", split) == {
        "url": "jdbc:test:", "driver": "none", "user": "me", "password": "secret", "connectTimeout": "60",
        "dbtable": "(select 1) T1", "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "100", "numPartitions": "8",
    }
    written = jdbc.write_options(DB, "T", writers=4, batch_size=5, isolation="READ_COMMITTED")
    assert (written["numPartitions"], written["batchsize"], written["isolationLevel"]) == ("4", "5", "READ_COMMITTED")
    assert "isolationLevel" not in jdbc.write_options(DB, "T")
    assert "secret" not in repr(DB)
    assert jdbc.check_batch_id("12") == 12
    for bad in (None, 0, -1):
        with pytest.raises(ValueError):
            jdbc.check_batch_id(bad)


def test_csv_forms(spark, tmp_path):
    rows = spark.createDataFrame([(1, "06851"), (2, "x,\"y")], "n int, code string")
    files.write_csv(rows, str(tmp_path / "c"))
    files.write_csv(rows, str(tmp_path / "c"), mode="append")
    assert sorted(files.read_csv(spark, str(tmp_path / "c"), rows.schema).collect()) == sorted(rows.collect() * 2)
    assert files.read_csv(spark, str(tmp_path / "c")).schema["n"].dataType.simpleString() == "int"
    assert files.read_csv_as_text(spark, str(tmp_path / "c")).schema["n"].dataType.simpleString() == "string"


def zipped(path, rows):
    with gzip.open(path, "wt") as out:
        out.writelines(line(key=f"{i % 7:05d}INR1000000000", local=f"{(i * 7919) % 10**9:016d}0") + "\n" for i in range(rows))


def test_large_zipped_files_are_dealt(spark, tmp_path):
    """Task rows within twice the mean, though one file has over half of the rows."""
    folder = tmp_path / "2025-01-01" / "ledger"
    folder.mkdir(parents=True)
    [name, *names] = [p.rsplit("/", 1)[1].replace("*", "").replace("[0-9][0-9][0-9]", "001") for p in family_patterns(str(folder))]
    zipped(folder / name, 30_000)
    for other in names:
        zipped(folder / other, 1_000)
    settings = {"spark.sql.files.maxPartitionBytes": "17k", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = gl_daily.day_lines(spark, str(tmp_path), "2025-01-01")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in spark.read.text(str(folder)).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 50_000 and max(sizes) <= 2 * sum(sizes) / len(sizes)
        assert max(plain) > 2 * sum(plain) / len(plain)
        # the scan of the small files does not open the large one
        small = spark.read.text(str(folder)).filter(~F.col("_metadata.file_path").isin([f"file:{folder / name}"]))
        (folder / name).write_bytes(b"\x1f\x8b not gzip")
        assert small.count() == 20_000
    finally:
        for key in settings:
            spark.conf.unset(key)
    (tmp_path / "2025-01-02" / "ledger").mkdir(parents=True)
    for other in [name, *names]:
        zipped(tmp_path / "2025-01-02" / "ledger" / other, 10)
    assert gl_daily.day_lines(spark, str(tmp_path), "2025-01-02").count() == 210
    assert files._bytes("128MB") == 1 << 27 and files._bytes("4194304") == 1 << 22 and files._bytes("64m") == 1 << 26


def test_batch_ids_are_given_once(spark, tmp_path):
    for folder in (str(tmp_path / "ids"), f"file://{tmp_path}/more"):
        with ThreadPoolExecutor(8) as drivers:
            ids = list(drivers.map(lambda _: batch_ids.next_batch_id(spark, folder), range(200)))
        assert sorted(ids) == list(range(1, 201))
    assert batch_ids.next_batch_id(spark, str(tmp_path / "more")) == 201
    held = batch_ids._HadoopFolder(spark, f"file://{tmp_path}/more")
    assert not held.claim(f"{201:012d}") and held.claim(f"{202:012d}") and len(held.names()) >= 202


def test_the_same_id_for_two_drivers_at_once(spark, tmp_path, monkeypatch):
    """Both have listed the folder before either claims."""
    monkeypatch.setattr(batch_ids._PosixFolder, "names", lambda self: [])
    assert [batch_ids.next_batch_id(spark, str(tmp_path)) for _ in range(3)] == [1, 2, 3]


def test_recon_of_bucketed_days_shuffles_nothing(spark, tmp_path, capsys):
    days = ["2025-01-01", "2025-01-02"]
    rows = spark.range(500).select(
        F.format_string("%05d", F.col("id") % 20).alias("BRANCH_CODE"),
        F.when(F.col("id") % 3 > 0, "INR").otherwise("USD").alias("CURRENCY"),
        F.format_string("1%09d", "id").alias("CGL"),
        (F.col("id") * 7 % 100).cast("decimal(38,3)").alias("BALANCE"),
    )
    tables = {name: {b: str(tmp_path / f"{name}-{b}") for b in (4, None)} for name in ("cbs", "gl", "diff")}

    def frames(buckets, day):
        for name, step in (("cbs", 0), ("gl", 1)):
            changed = F.when(F.col("CGL").substr(8, 3).cast("int") % (5 + day) == 0, F.col("BALANCE") + step + day).otherwise(F.col("BALANCE"))
            closing = rows.withColumn("BALANCE", changed).withColumn("BALANCE_DATE", F.lit(days[day]).cast("date"))
            published.write_day(closing, tables[name][buckets], "BALANCE_DATE", days[day], buckets=feeds.ledger_buckets(buckets))
        return [published.read_day(spark, tables[n][buckets], "BALANCE_DATE", days[day]) for n in ("cbs", "gl")]

    found, plans = {}, {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for buckets in (4, None):
            table = tables["diff"][buckets]
            history = spark.createDataFrame([], "BRANCH_CODE string, CURRENCY string, CGL string, DIFFERENCE_AMOUNT decimal(20,4), RECON_DAY date")
            for i, day in enumerate(days):
                cbs, gl = frames(buckets, i)
                inputs = {"cbs": cbs, "gl": gl, "history": history, "previous_date": days[i - 1] if i else "2024-12-31", "run_time": F.lit(None).cast("timestamp")}
                recon_daily.recon_frame(recon_date=day, **inputs).explain()
                plans[buckets] = capsys.readouterr().out
                recon_daily.run_recon(table, day, buckets, **inputs)
                history = published.read_day(spark, table, "RECON_DAY", day)
            found[buckets] = sorted(map(str, published.read_days(spark, table, "RECON_DAY").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[4] == found[None] and len(found[4]) > 100
    assert "Exchange" not in plans[4] and plans[4].count("Bucketed: true") == 3 and plans[None].count("Exchange") >= 3
    # a day written again without buckets, or added to, is read as it is
    cbs = published.read_day(spark, tables["cbs"][4], "BALANCE_DATE", days[1])
    published.write_day(cbs.limit(3), tables["cbs"][4], "BALANCE_DATE", days[1], append=True)
    assert published.read_day(spark, tables["cbs"][4], "BALANCE_DATE", days[1]).count() == 503
    with pytest.raises(RuntimeError, match="nothing is published"):
        published.write_day(cbs, tables["cbs"][4], "BALANCE_DATE", days[0], buckets=feeds.ledger_buckets(4))
    with pytest.raises(ValueError, match="single day"):
        published.write_day(cbs, tables["cbs"][4], "BALANCE_DATE", days[1], append=True, buckets=feeds.ledger_buckets(4))
    none = cbs.limit(0)
    assert published.write_day(none, tables["cbs"][4], "BALANCE_DATE", days[1], buckets=feeds.ledger_buckets(4)) == 0
    assert published.read_day(spark, tables["cbs"][4], "BALANCE_DATE", days[1]).isEmpty()


def test_jobs_with_buckets(spark, tmp_path):
    tables = gl_daily.GlTables(str(tmp_path / "txn"), str(tmp_path / "bal"))
    gl_daily.run_gl_day(spark, day_lines(spark, 500, -200), master(spark), tables, "2025-01-01", "1", None, buckets=3)
    gl_daily.run_gl_day(spark, day_lines(spark, 100), master(spark), tables, "2025-01-02", "2", "2025-01-01", buckets=3)
    feeds.run_feeds(spark, {"INV": lines(spark, feed_line("INV", "1000", "+"))}, str(tmp_path / "cbs"), "2025-01-01", None, buckets=3)
    assert closing(spark, tables.balances) == {"2025-01-01": 3, "2025-01-02": 4}
    assert closing(spark, str(tmp_path / "cbs")) == {"2025-01-01": 1}
