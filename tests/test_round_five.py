"""Work that a row makes once: parses, casts and orders that must not be repeated."""

import json

from pyspark.sql import functions as F

from tickloom.operators import l4
from tickloom.plans import market
from tickloom.sources import diffs, views


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def event(diff, **more):
    return {"user": "u", "oid": 7, "coin": "X", "side": "B", "px": "1", "raw_book_diff": diff} | more


def test_events_whose_keys_decide(spark):
    new = {"new": {"sz": "5"}}
    good = json.dumps(event(new))
    lines = {
        good: (None, "new", "5", None, None),
        json.dumps(event("remove")): (None, "remove", None, None, None),
        json.dumps(event({"update": {"origSz": "5", "newSz": "3"}})): (None, "update", None, "5", "3"),
        json.dumps(event({"update": {"orig_sz": 5, "new_sz": 3, "newSz": None}})): ("unsupported diff",),
        json.dumps(event({"update": {"orig_sz": 5, "new_sz": 3}})): (None, "update", None, "5", "3"),
        json.dumps(event({"update": {"origSz": "5", "newSz": "3", "x": "1"}})): ("unsupported diff",),
        json.dumps(event({"new": {"sz": "5", "x": 1}})): ("unsupported diff",),
        json.dumps(event({"new": {"sz": None}})): ("unsupported diff",),
        json.dumps(event({"new": '{"sz":"5"}'})): ("unsupported diff",),
        json.dumps(event({"new": {"sz": "5"}, "x": 1})): ("unsupported diff",),
        json.dumps(event(new))[:-1] + ',"raw_book_diff":{"new":{"sz":"5","sz":"6"}}}': (None, "new", "6", None, None),
        json.dumps(event(None, rawBookDiff=new)): ("unsupported diff",),
        json.dumps({k: v for k, v in event(None, rawBookDiff=new).items() if k != "raw_book_diff"}): (None, "new", "5", None, None),
        json.dumps({k: v for k, v in event(new).items() if k != "px"}): ("missing px",),
        json.dumps(event(new, px=None)): (None, "new", "5", None, None),
        json.dumps(event(new, side="?")): ("bad side",),
        json.dumps(event(new, oid="x")): ("bad oid",),
        f"[{good}]": ("not an object",),
        good[:-1]: ("not an object",),
        " \n" + good: (None, "new", "5", None, None),
    }
    rows = spark.createDataFrame([(i, e) for i, e in enumerate(lines)], "ordinal long, e string")
    got = {r.ordinal: r for r in diffs.parse_event(rows).collect()}
    for i, want in enumerate(lines.values()):
        r = got[i]
        assert (r.reason, r.kind, r.sz, r.orig_sz, r.new_sz)[: len(want)] == want, list(lines)[i]


def items(spark, folder, n=40):
    rows = [(o, o * 7 + k, k, float(1 + (o + k) % 9), "ANR"[(o + k) % 3], "OF"[k % 2]) for o in range(n) for k in range(1, 5)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_lines_and_their_events_are_parsed_once(spark, tmp_path):
    """A filter on the reason took all parses below itself along: each event was parsed some thirty times."""
    d = items(spark, tmp_path)
    for name in ("diff_lines", "diff_counters"):
        told = plan(market.QUERIES[name](spark, d))
        assert told.count("from_json(") == 3 and told.count("to_json(") + told.count("StructsToJsonEvaluator") == 1, name
    assert market.QUERIES["diff_lines"](spark, d).agg(F.sum("diffs")).first()[0] == sum((8 * o + k) % 7 > 0 for o in range(40) for k in range(1, 5))


def test_frames_are_written_and_parsed_once_by_all_cores(spark):
    told = plan(market.QUERIES["frames_books"](spark, "/root/testdata/sf0.001"))
    assert told.count("from_json(") == 1 and told.count("to_json(") + told.count("StructsToJsonEvaluator") == 1
    assert "RepartitionByExpression" in told


def test_orders_are_dealt_out_before_they_are_ordered(spark):
    rows = [("X", 1, 0, 1, "B", "5.0", "new", "1", None), ("X", 2, 0, 1, "B", "5.0", "remove", None, None), ("X", 3, 0, 2, "B", "5.0", "new", "1", None), ("X", 4, 0, 3, "B", "5", "new", "1", None),
            ("X", 5, 0, 2, "B", "5.0", "remove", None, None), ("X", 6, 0, 3, "B", "5", "remove", None, None), ("X", 6, 1, 4, "B", "5.00", "new", "2", None)]
    d = spark.createDataFrame(rows, "coin string, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string")
    assert "RepartitionByExpression" in plan(l4.final_orders(d)) and "Aggregate" not in plan(l4.level_texts(d))
    assert sorted((r.height, r.px) for r in l4.level_texts(d).collect()) == [(1, "5.0"), (6, "5.00")]
