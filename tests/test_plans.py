"""Physical-plan properties the operators rely on at scale (read from explain())."""

import re

import __spark_entry__ as entry
from helpers import SF_SMALL


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_scan_prunes_columns_and_pushes_filter(spark, capsys):
    plan = _plan(entry.queries()["hot_items_topn"](spark, SF_SMALL), capsys)
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert pushed and all("EqualTo(event_type,view)" in p and "IsNotNull(event_type)" in p for p in pushed)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all(s == "struct<ts:timestamp_ntz,event_type:string,props:string>" for s in schemas)


def test_topn_limits_before_shuffle(spark, capsys):
    plan = _plan(entry.queries()["hot_items_topn"](spark, SF_SMALL), capsys)
    assert re.search(r"WindowGroupLimit \(\d+\)[\s\S]*Partial", plan)


def test_quota_plan_does_not_depend_on_the_quota(spark, capsys):
    from clickstream.operators.quota import quota_filter
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id", "ts", "event_id")
    plans = [re.sub(r"\b(100|5000|101|5001)\b|#\d+L?|plan_id=\d+", "", _plan(quota_filter(ev, "user_id", "ts", "event_id", n).passed, capsys))
             for n in (100, 5000)]
    assert plans[0] == plans[1]


def test_interval_join_uses_time_bucket_key(spark, capsys):
    plan = _plan(entry.queries()["tx_interval_join"](spark, SF_SMALL), capsys)
    m = re.search(r"Left keys \[2\]: \[user_id#\d+L, _tb#\d+L\]", plan)
    assert m, plan


def test_sweep_has_no_per_event_expansion(spark, capsys):
    # the sliding count aggregates buckets before any Generate (explode)
    plan = _plan(entry.queries()["behaviour_counts_1h_10s"](spark, SF_SMALL), capsys)
    tree = plan.split("\n\n")[0]
    lines = [l for l in tree.splitlines() if l.strip()]
    agg_line = max(i for i, l in enumerate(lines) if "HashAggregate" in l)
    gen_lines = [i for i, l in enumerate(lines) if "Generate" in l]
    assert gen_lines and all(i < agg_line for i in gen_lines)  # every Generate sits above the bucket aggregate
