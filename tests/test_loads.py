"""Initial, incremental and streaming loads, run again and after crashes."""

import importlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import tillroll.plans.load as load_plan
from conftest import at, rows
from queries.registry import QUERIES
from tillroll.adapters import table
from tillroll.operators.clean import Validity
from tillroll.plans.load import append_new, incremental_load, increment_stats, initial_load, profile
from tillroll.operators.star import star_join
from tillroll.sources import (
    changing,
    compact,
    manifest,
    new_folder,
    read_catalog,
    read_days,
    read_dimension,
    read_lake,
    read_mark,
    read_summaries,
    read_transactions,
    refresh_summary,
    register_lake,
    vacuum,
    write_dimension,
    write_mark,
    write_transactions,
)
from tillroll.operators.star import by_name, roll_up
from tillroll.plans.dashboard import kept_sales, kpi_metrics, open_lake_dashboard
from tillroll.sources.manifest import KEPT, LakeChanged
from tillroll.streaming.landing import land_batch, land_stream

lake_module = importlib.import_module("tillroll.sources.lake")

CUTOFF = "2024-01-10 12:00:00"
HISTORY = [
    (1, 1, 1, 100, "2024-01-09 08:00:00"),
    (2, 1, 2, 100, "2024-01-10 12:00:00"),
    (2, 1, 2, 100, "2024-01-10 12:00:00"),
    (3, 9, 2, 100, "2024-01-10 11:00:00"),
]
NEW = [
    (4, 1, 1, 100, "2024-01-10 12:00:00.000001"),
    (5, 9, None, -5, "2024-01-11 09:00:00"),
    (6, 2, 1, 100, "2024-01-12 09:00:00.250000"),
]


def ids(spark, lake):
    return sorted(r["transaction_id"] for r in read_transactions(spark, lake).collect())


def mark(spark, lake):
    return read_mark(spark, lake, CUTOFF).first()["mark"]


def test_initial_load_cleans_and_seeds_the_mark(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    assert ids(spark, lake) == [1, 2]
    assert mark(spark, lake) == at(CUTOFF)
    parts = read_transactions(spark, lake).select("year", "month", "day").distinct()
    assert sorted(rows(parts)) == [(2024, 1, 9), (2024, 1, 10)]
    assert read_dimension(spark, lake, "truck").count() == 4
    assert read_dimension(spark, lake, "payment").count() == 2


def test_increment_is_taken_uncleaned_and_only_once(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    found = incremental_load(star.fact, lake, CUTOFF)
    assert (found.rows, found.latest) == (3, at(NEW[-1][4]))
    assert ids(spark, lake) == [1, 2, 4, 5, 6]
    assert mark(spark, lake) == at(NEW[-1][4])  # microseconds kept, so nothing is read twice
    assert incremental_load(star.fact, lake, CUTOFF).rows == 0
    assert ids(spark, lake) == [1, 2, 4, 5, 6]


def test_increment_can_be_cleaned(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    incremental_load(star.fact, lake, CUTOFF, Validity())
    assert ids(spark, lake) == [1, 2, 4, 6]
    assert mark(spark, lake) == at(NEW[-1][4])


def test_repeats_inside_an_increment_stay_unless_cleaned(spark, fleet, lake):
    star = fleet(*NEW, NEW[0])
    incremental_load(star.fact, lake, CUTOFF)
    assert ids(spark, lake) == [4, 4, 5, 6]


class Lost(RuntimeError):
    pass


@pytest.fixture
def losing(monkeypatch):
    """Crash the next change of a lake, before or after its manifest is there."""
    real = lake_module.publish

    def lose(when):
        def crash(*args):
            monkeypatch.setattr(lake_module, "publish", real)
            if when == "after":
                real(*args)
            raise Lost

        monkeypatch.setattr(lake_module, "publish", crash)

    return lose


@pytest.mark.parametrize("when", ["before", "after"])
def test_crash_between_append_and_mark(spark, fleet, lake, losing, when):
    star = fleet(*HISTORY, *NEW, (None, 1, 1, 7, "2024-01-12 07:00:00"))
    initial_load(star, lake, CUTOFF)
    losing(when)
    with pytest.raises(Lost):
        incremental_load(star.fact, lake, CUTOFF)
    assert mark(spark, lake) == at(CUTOFF if when == "before" else NEW[-1][4])
    assert read_transactions(spark, lake).count() == (2 if when == "before" else 6)
    incremental_load(star.fact, lake, CUTOFF)
    landed = [r["transaction_id"] for r in read_transactions(spark, lake).collect()]
    assert sorted(landed, key=repr) == [1, 2, 4, 5, 6, None]


def test_half_an_append_is_never_read(spark, facts, lake, losing):
    write_transactions(facts(*HISTORY), lake, "append")
    reader = read_transactions(spark, lake)
    losing("before")
    with pytest.raises(Lost):
        write_transactions(facts(*NEW), lake, "append")
    assert read_transactions(spark, lake).count() == reader.count() == 4
    # the next change takes the same folder, and nothing of the lost one is in it
    write_transactions(facts(NEW[2]), lake, "append")
    assert ids(spark, lake) == [1, 2, 2, 3, 6]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_reload_is_there_as_a_whole_or_not_at_all(spark, fleet, lake, losing, when):
    initial_load(fleet(*HISTORY), lake, CUTOFF)
    reader = star_join(read_lake(spark, lake))
    other = fleet((8, 1, 1, 100, "2024-01-08 08:00:00"), (9, 2, 1, 100, "2024-01-10 08:00:00"))
    losing(when)
    with pytest.raises(Lost):
        initial_load(other, lake, "2024-01-10 10:00:00")
    assert (ids(spark, lake), mark(spark, lake)) == (
        ([1, 2], at(CUTOFF)) if when == "before" else ([8, 9], at("2024-01-10 10:00:00"))
    )
    assert reader.count() == 2  # who was reading goes on with the old lake


def test_two_writers_do_not_lose_each_others_sales(spark, facts, lake):
    with pytest.raises(LakeChanged):
        with changing(spark, lake) as slow:
            slow.add_sales(facts(*HISTORY))
            write_transactions(facts(*NEW), lake, "append")
    assert ids(spark, lake) == [4, 5, 6]


def test_late_sales_within_the_look_back_land_once(spark, facts, lake):
    incremental_load(facts(*NEW), lake, CUTOFF)
    late = (7, 1, 1, 100, "2024-01-11 10:00:00")
    too_late = (8, 1, 1, 100, "2024-01-10 13:00:00")
    for _ in range(2):
        incremental_load(facts(*NEW, late, too_late), lake, CUTOFF, look_back=timedelta(days=1, hours=12))
        assert ids(spark, lake) == [4, 5, 6, 7]
        assert mark(spark, lake) == at(NEW[-1][4])


def test_an_increment_is_scanned_once_and_joined_only_if_it_must(spark, facts, lake, monkeypatch):
    joins = []
    real = load_plan.unlanded
    monkeypatch.setattr(load_plan, "unlanded", lambda *a, **k: joins.append(1) or real(*a, **k))
    reads = spark.sparkContext.accumulator(0)
    folder = new_folder(spark, "source")
    facts(*HISTORY, *NEW).write.parquet(folder)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(folder)
    counted = source.mapInArrow(seen, source.schema)
    for _ in range(2):
        incremental_load(counted, lake, "2024-01-01 00:00:00")
    assert (joins, reads.value) == ([], 14)
    write_mark(spark, lake, at("2024-01-12 00:00:00"))
    incremental_load(counted, lake)
    assert joins == [1] and len(ids(spark, lake)) == 7


def test_an_empty_increment_changes_nothing(spark, facts, lake):
    assert incremental_load(facts(), lake, CUTOFF).rows == 0
    assert manifest(spark, lake).number == 0
    incremental_load(facts(*NEW), lake, CUTOFF)
    write_mark(spark, lake, at(CUTOFF))
    assert incremental_load(facts(*NEW), lake, CUTOFF).rows == 0  # all of it is landed
    assert ids(spark, lake) == [4, 5, 6]
    assert incremental_load(facts((9, 1, 1, 5, None)), lake, CUTOFF).rows == 0


def test_old_manifests_go_and_the_mark_stays(spark, lake):
    for second in range(KEPT + 5):
        write_mark(spark, lake, at(f"2024-01-12 07:00:{second:02d}"))
    assert mark(spark, lake) == at(f"2024-01-12 07:00:{KEPT + 4:02d}")
    from tillroll.sources.shared import subfolders

    assert len(subfolders(spark, lake.manifest)) <= KEPT + 1


def test_compaction_touches_only_days_in_several_loads(spark, facts, lake):
    write_transactions(facts(*HISTORY, *NEW), lake, "overwrite")
    more = [(20 + i, 1, 1, 5, f"2024-01-12 10:0{i}:00") for i in range(3)]
    for sale in more:
        write_transactions(facts(sale), lake, "append")
    before = set(read_transactions(spark, lake).inputFiles())
    landed = sorted(rows(read_transactions(spark, lake)))
    assert compact(spark, lake) == {date(2024, 1, 12)}
    after = set(read_transactions(spark, lake).inputFiles())
    assert sorted(rows(read_transactions(spark, lake))) == landed
    assert {f for f in before if "day=12/" not in f} == {f for f in after if "day=12/" not in f}
    assert len([f for f in before if "day=12/" in f]) == 4
    assert len([f for f in after if "day=12/" in f]) == 1
    assert compact(spark, lake) == frozenset()
    assert rows(read_days(spark, lake, [date(2024, 1, 12)]).groupBy().count()) == [(4,)]


def test_vacuum_takes_only_what_is_not_read(spark, fleet, lake, losing):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    incremental_load(star.fact, lake, CUTOFF)
    write_transactions(star.fact.where("transaction_id = 6"), lake, "append")
    refresh_summary(spark, lake)
    losing("before")
    with pytest.raises(Lost):
        write_dimension(star.truck, lake, "truck")
    compact(spark, lake)
    initial_load(star, lake, CUTOFF)
    landed = sorted(rows(star_join(read_lake(spark, lake))))
    assert vacuum(spark, lake) > 4
    assert sorted(rows(star_join(read_lake(spark, lake)))) == landed
    assert vacuum(spark, lake) == 0


GRAINS = ("date", "hour_of_day", "price_segment")


def test_the_summary_follows_loads_compaction_and_reloads(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)

    def agrees():
        kept = kept_sales(spark, lake, *GRAINS)
        whole = roll_up(read_lake(spark, lake), *GRAINS)
        return sorted(rows(by_name(kept)), key=repr) == sorted(rows(by_name(whole)), key=repr)

    initial_load(star, lake, CUTOFF)
    first = refresh_summary(spark, lake)
    assert len(first) == 1 and agrees()
    incremental_load(star.fact, lake, CUTOFF)
    assert not agrees()
    second = refresh_summary(spark, lake)
    assert len(second) == 1 and not first & second and agrees()  # only the new load is read
    assert refresh_summary(spark, lake) == frozenset()
    write_transactions(star.fact.where("transaction_id = 6"), lake, "append")
    compact(spark, lake)
    assert agrees() and refresh_summary(spark, lake) == frozenset()
    assert len(manifest(spark, lake).summaries) == 1
    initial_load(star, lake, CUTOFF)
    assert read_summaries(spark, lake, manifest(spark, lake)).count() == 0
    refresh_summary(spark, lake)
    assert agrees()


def test_a_lake_dashboard_scans_no_sale(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    incremental_load(star.fact, lake, CUTOFF)
    with open_lake_dashboard(spark, lake) as view:
        for grain in GRAINS:
            read = kept_sales(spark, lake, grain).inputFiles()
            assert read and not any("transaction_table" in f for f in read)
        assert rows(view.kpis) == rows(kpi_metrics(roll_up(read_lake(spark, lake), "date")))


def test_late_sale_is_lost_to_the_batch_but_not_to_the_stream(spark, facts, lake):
    incremental_load(facts(*NEW), lake, CUTOFF)
    late = (7, 1, 1, 100, "2024-01-11 10:00:00")
    incremental_load(facts(*NEW, late), lake, CUTOFF)
    assert ids(spark, lake) == [4, 5, 6]
    land_batch(facts(late), lake)
    assert ids(spark, lake) == [4, 5, 6, 7]


def test_initial_load_again_restarts_the_mark(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    for _ in range(2):
        initial_load(star, lake, CUTOFF)
        incremental_load(star.fact, lake, CUTOFF)
        assert ids(spark, lake) == [1, 2, 4, 5, 6]


def test_profile_and_stats(spark, facts):
    increment = facts(*NEW)
    found = profile(increment)
    assert (found.rows, len(found.days)) == (3, 3)
    assert rows(increment_stats(increment)) == [(3, found.latest)]
    assert profile(facts()).latest is None


def test_catalog_sees_appended_days(spark, fleet, lake):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    database = "catalog_" + lake.root.rsplit("-", 1)[1]
    register_lake(spark, lake, database)
    name = f"{database}.transaction_table"
    assert spark.table(name).count() == 2
    incremental_load(star.fact, lake, CUTOFF, table=name)
    assert spark.table(name).count() == 5
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4
    assert spark.table(f"{database}.truck_table").count() == 4


def write_file(facts, folder, *sales):
    facts(*sales).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("when", ["before", "after"])
def test_stream_survives_failure_and_redelivery(spark, facts, lake, losing, monkeypatch, when):
    import tillroll.streaming.landing as landing

    folder, checkpoint = new_folder(spark, "drop"), new_folder(spark, "landing")
    write_file(facts, folder, NEW[2], (8, 1, 1, 5, "2024-01-01 00:00:00"))
    write_file(facts, folder, NEW[0], NEW[0], NEW[1], (9, 1, 1, 5, None))
    real, joins = landing.unlanded, []
    monkeypatch.setattr(landing, "unlanded", lambda *a, **k: joins.append(1) or real(*a, **k))
    run = lambda: land_stream(
        spark, folder, lake, checkpoint, maxFilesPerTrigger="1"
    ).awaitTermination()
    losing(when)
    with pytest.raises(Exception, match="Lost"):
        run()
    run()
    assert ids(spark, lake) == [4, 5, 6, 8]
    assert len(joins) == (3 if when == "before" else 2)  # a replay is known by its number
    write_file(facts, folder, *NEW)
    run()
    assert ids(spark, lake) == [4, 5, 6, 8]
    run_anew = land_stream(spark, folder, lake, new_folder(spark, "landing"))
    run_anew.awaitTermination()  # another stream, so its batches are looked at
    assert ids(spark, lake) == [4, 5, 6, 8]


def test_append_lists_only_the_touched_days(spark, facts, lake):
    incremental_load(facts(*NEW), lake, CUTOFF)
    some = read_days(spark, lake, [date(2024, 1, 12), date(2024, 1, 10), date(2024, 2, 29)])
    assert {f.rsplit("/", 2)[1] for f in some.inputFiles()} == {"day=10", "day=12"}
    assert sorted(r["transaction_id"] for r in some.collect()) == [4, 6]
    assert rows(read_days(spark, lake, [])) == []
    append_new(facts(*NEW), lake, profile(facts(*NEW)).days)
    assert ids(spark, lake) == [4, 5, 6]


def test_crash_inside_a_second_initial_load_leaves_no_gap(spark, fleet, lake, monkeypatch):
    star = fleet(*HISTORY, *NEW)
    initial_load(star, lake, CUTOFF)
    incremental_load(star.fact, lake, CUTOFF)
    with monkeypatch.context() as patch:
        patch.setattr(lake_module.Draft, "put_dimension", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            initial_load(star, lake, CUTOFF)
    assert ids(spark, lake) == [1, 2, 4, 5, 6]
    incremental_load(star.fact, lake, CUTOFF)
    assert ids(spark, lake) == [1, 2, 4, 5, 6]


def test_many_days_reach_the_catalog(spark, facts, lake, fleet):
    star = fleet(*[(i, 1, 1, 100, str(datetime(2024, 1, 1) + timedelta(days=i))) for i in range(6)])
    write_dimension(star.truck, lake, "truck")
    write_dimension(star.payment, lake, "payment")
    write_transactions(star.fact.where("transaction_id = 0"), lake, "overwrite")
    database = "many_" + lake.root.rsplit("-", 1)[1]
    register_lake(spark, lake, database)
    lake_module_calls = lake_module._PARTITIONS_PER_CALL
    try:
        lake_module._PARTITIONS_PER_CALL = 2
        incremental_load(star.fact, lake, "2024-01-01", table=f"{database}.transaction_table")
    finally:
        lake_module._PARTITIONS_PER_CALL = lake_module_calls
    assert star_join(read_catalog(spark, database)).count() == 6
    assert star_join(read_lake(spark, lake)).count() == 6


def test_stream_query_reads_a_table_of_several_files(spark, sf_dir):
    folder = new_folder(spark, "tables")
    events = table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    landed = QUERIES["stream_incremental_load"](spark, folder)
    assert landed.count() == events.count()


def test_sales_without_an_id_differ_by_any_column(spark, facts, lake):
    first, second = (None, 1, 1, 5, "2024-01-12 07:00:00"), (None, 1, 1, 5, "2024-01-12 07:00:01")
    other = (None, 2, 1, 5, "2024-01-12 07:00:00")  # the same instant, another truck
    zero = (0, 1, 1, 5, "2024-01-12 07:00:00")  # not the same as no id
    for batch in ((first, other), (first, first, second, zero), (zero, second, other)):
        land_batch(facts(*batch), lake)
    landed = read_transactions(spark, lake).collect()
    found = [(r["transaction_id"], r["truck_id"], r["at"].second) for r in landed]
    assert sorted(found, key=repr) == sorted(
        [(0, 1, 0), (None, 1, 0), (None, 1, 1), (None, 2, 0)], key=repr
    )


def test_a_crash_in_writing_the_mark_keeps_the_old_one(spark, lake, monkeypatch):
    write_mark(spark, lake, at("2024-01-12 07:00:00"))
    write_mark(spark, lake, at("2024-01-11 07:00:00"))  # a rewind counts too
    assert mark(spark, lake) == at("2024-01-11 07:00:00")
    with monkeypatch.context() as patch:
        patch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_mark(spark, lake, at("2024-01-13 07:00:00"))
    assert mark(spark, lake) == at("2024-01-11 07:00:00")


def test_the_catalog_forgets_days_that_are_gone(spark, facts, lake):
    both = facts((1, 1, 1, 5, "2024-01-12 07:00:00"), (2, 1, 1, 5, "2024-01-13 07:00:00"))
    write_transactions(both, lake, "overwrite")
    database = f"gone_{lake.root.rsplit('-', 1)[1]}"
    register_lake(spark, lake, database)
    write_transactions(both.where("transaction_id = 1"), lake, "overwrite")
    register_lake(spark, lake, database)
    days = [r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.transaction_table").collect()]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert days == ["year=2024/month=1/day=12"]


def test_landing_shuffles_a_batch_once_before_the_write(spark, facts, lake):
    land_batch(facts(*NEW), lake)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        found = load_plan.profile(facts(*NEW))
        fresh = load_plan.unlanded(facts(*NEW), lake, manifest(spark, lake), found.days, once=True)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("Exchange hashpartitioning") == 2  # the batch and the lake


def test_the_catalog_follows_a_day_that_grows(spark, fleet, facts, lake):
    initial_load(fleet(*HISTORY), lake, CUTOFF)
    database = "grows_" + lake.root.rsplit("-", 1)[1]
    register_lake(spark, lake, database)
    name = f"{database}.transaction_table"
    for _ in range(2):
        incremental_load(facts(*HISTORY, *NEW), lake, CUTOFF, table=name)
    assert spark.table(name).count() == read_transactions(spark, lake).count() == 5
    assert spark.table(name).where(F.col("day") == 10).count() == 2  # one of them was there before
    initial_load(fleet(HISTORY[0]), lake, CUTOFF)
    register_lake(spark, lake, database)
    assert spark.table(name).count() == 1
    spark.sql(f"DROP DATABASE {database} CASCADE")
