from pyspark.sql import functions as F

from quayside.operators import metrics


def test_tasks_of_a_usage_report_follow_its_rows(spark, monkeypatch):
    """Also where one item has most of the rows: no task holds them all, and each pair comes once."""
    frames, write = {}, metrics.saved if hasattr(metrics, "saved") else None

    def held(df, label, *rest):
        frames[label] = df
        return write(df, label, *rest)

    monkeypatch.setattr(metrics, "saved", held, raising=False)
    monkeypatch.setattr(metrics, "TASK_ROWS", 100, raising=False)
    used = [(1, u) for u in range(500)] * 3 + [(2 + k % 40, k % 7) for k in range(300)] + [(2, None), (None, 3), (None, None), (99, 1)]
    items = [(k, f"i{k}" if k % 2 else None) for k in range(60)] + [(1, "again"), (None, "none")]
    users = [(u, f"u{u}") for u in range(0, 600, 2)] + [(4, "twin")]
    report = metrics.usage_pairs(
        spark.createDataFrame(items, "item_id long, item_name string"),
        spark.createDataFrame(used, "item_id long, user_id long"),
        spark.createDataFrame(users, "user_id long, user_name string"),
    )
    names = {}
    for u, name in users:
        names.setdefault(u, []).append(name)
    want = []
    for k, name in items:
        whose = {u for i, u in used if i is not None and i == k}
        shown = name if name is not None else str(k)
        want += [(k, shown, n) for u in whose for n in names.get(u, [metrics.DELETED_USER])] or [(k, shown, None)]
    assert sorted(map(str, map(tuple, report.collect()))) == sorted(map(str, want))
    pairs = frames.get("usage-pairs", report)
    assert pairs.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 400
