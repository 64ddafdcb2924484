"""Tables in buckets by order: what goes by order moves no row."""

from pyspark.sql import functions as F

from conftest import event
from orderloom.operators import lifecycle as lc
from orderloom.operators import linkage as lk
from orderloom.operators import quality as dq
from orderloom.operators import reconcile as rc
from orderloom.plans import queries
from orderloom.plans.workspace import AS_OF_MS, Workspace
from orderloom.session import cut_lineage, delete_folder
from orderloom.sources import derived
from test_scale import same, write_tables


def moves(df):
    """Shuffles in the plan of a frame."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_work_by_order_moves_no_unique_event(spark, tmp_path):
    w = Workspace(spark, write_tables(spark, tmp_path, copies=2))
    events = w.unique_events()
    plain = spark.createDataFrame(events.collect(), events.schema)
    assert moves(lc.lifecycle_snapshot(events, 0)) == 0
    assert moves(lc.order_history(events)) == 0
    found = dq.all_exceptions(events, w.snapshots(), AS_OF_MS)
    assert moves(found) == 0
    assert same(found, dq.all_exceptions(plain, lc.lifecycle_snapshot(plain, 0), AS_OF_MS))
    assert same(lc.order_history(events), lc.order_history(plain))


def test_an_order_lies_in_one_bucket_of_each_table(spark, tmp_path):
    w = Workspace(spark, write_tables(spark, tmp_path, copies=2))
    bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).alias("bucket")
    for rows in (w.event_log(), w.unique_events(), w.snapshots(), w.published()):
        places = rows.select("customer_order_id", bucket).distinct()
        assert places.where("bucket = ''").isEmpty()
        assert places.groupBy("customer_order_id").count().where("count > 1").isEmpty()


def test_an_emptied_folder_is_written_again(spark, tmp_path):
    w = Workspace(spark, write_tables(spark, tmp_path, copies=2))
    before = w.unique_events()
    rows = spark.createDataFrame(before.collect(), before.schema)
    for file in ("event_log", "resent"):
        found = [f for f in w.unique_events().inputFiles() if f"/{file}-" in f]
        delete_folder(spark, found[0][:found[0].index(f"/{file}-")] + "/" + next(
            p for p in found[0].split("/") if p.startswith(f"{file}-")))
        assert same(w.unique_events(), rows)
        assert same(w.event_log(), derived.event_log(w.spark, w.sf_dir))


def test_rounds_of_a_walk_move_nothing(spark, log):
    rows = [event("NEW", firm_order_id="n0")] + [
        event("REPLACE", i, firm_order_id=f"n{i}", parent_firm_order_id=f"n{i - 1}")
        for i in range(1, 9)]
    found = lk.descendants(log(rows))
    assert moves(found) == 0
    assert sorted((r.depth, r.firm_order_id, r.parent_firm_order_id) for r in found.collect()) == [
        (i, f"n{i}", f"n{i - 1}" if i else None) for i in range(9)]


def test_orders_of_a_node_are_found_without_moving_events(spark, log, monkeypatch):
    """The events of other orders stay where they are: the join that drops them is a broadcast."""
    rows = [event("NEW", firm_order_id="F1")] + [
        event("NEW", customer_order_id=f"O{i}", firm_order_id=f"F{i}") for i in range(2, 9)]
    rows += [event("REPLACE", 5, firm_order_id="F1-r", parent_firm_order_id="F1")]
    plans = {}

    def kept(df, name, *more):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df, name, *more)

    monkeypatch.setattr(lk, "cut_lineage", kept)
    found = lk.descendants_of(log(rows), "F1")
    assert sorted((r.firm_order_id, r.depth) for r in found.collect()) == [("F1", 0), ("F1-r", 1)]
    assert "BroadcastHashJoin" in plans["nodes"] and "SortMergeJoin" not in plans["nodes"]


def test_only_possible_copies_are_moved_to_drop_them(spark, log, tmp_path):
    """Recomputation and the chain from messages tell copies by a map of hashes first."""
    rows = [event("NEW", i, event_id=f"e{i % 7}", customer_order_id=f"O{i % 3}") for i in range(9)]
    rows += [event("NEW", 3, event_id="e3", customer_order_id="O0", ts_ingest=1)]
    events = log(rows)
    again = rc.recompute_affected(events, events.where("customer_order_id = 'O0'"), 0)
    assert "bitmap_construct_agg" in again._jdf.queryExecution().executedPlan().toString()
    unique = events.dropDuplicates(["event_id", "event_time"])
    assert again.collect() == lc.lifecycle_snapshot(
        unique.where("customer_order_id = 'O0'"), 0).collect()
    chain = queries.lifecycle_from_messages(
        Workspace(spark, write_tables(spark, tmp_path, copies=2)))
    assert "bitmap_construct_agg" in chain._jdf.queryExecution().executedPlan().toString()
