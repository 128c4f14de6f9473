from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import density, timeline
from broadsheet.session import durable, shared_folder

START = datetime(2011, 5, 18)


def naive(rows):
    frame = pd.DataFrame(rows, columns=["doc_id", "date", "class"])
    frame["class"] = frame["class"].astype(object)
    frame["_null"] = frame["date"].isna()
    frame = frame.sort_values(["_null", "date", "class", "doc_id"], na_position="first").reset_index(drop=True)
    frame["csum"] = frame.groupby("class", dropna=False).cumcount() + 1
    frame["total"] = np.arange(len(frame)) + 1
    return {r.doc_id: (r.csum, r.total) for r in frame.itertuples()}


def counted(spark, rows):
    df = spark.createDataFrame(rows, "doc_id BIGINT, date TIMESTAMP, class STRING").repartition(5)
    return {r.doc_id: (r.csum, r.total) for r in timeline.class_timeline(df).collect()}


def test_small_timeline(spark):
    rows = [(1, START, "A"), (2, START + timedelta(1), "B"), (3, START + timedelta(2), "A")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, date TIMESTAMP, class STRING")
    got = [(r.csum, r.total, round(r.share, 6)) for r in timeline.class_timeline(df).orderBy("total").collect()]
    assert got == [(1, 1, 1.0), (1, 2, 0.5), (2, 3, 0.666667)]


def test_one_date_and_one_class_hold_most_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(4000):
        date = START if rng.random() < 0.5 else START + timedelta(seconds=int(rng.integers(0, 500)))
        rows.append((int(i * 7 % 4001), date, "hot" if rng.random() < 0.6 else f"c{rng.integers(0, 5)}"))
    assert counted(spark, rows) == naive(rows)


def test_missing_dates_and_classes_are_counted_too(spark):
    rows = [(i, None if i % 3 == 0 else START + timedelta(i % 4), None if i % 5 == 0 else "abc"[i % 3]) for i in range(200)]
    assert counted(spark, rows) == naive(rows)


def test_labels_and_chosen_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, 10)], "doc_id BIGINT, class INT")
    labels = spark.createDataFrame([(0, "bail")], "class INT, label STRING")
    shown = timeline.label_classes(timeline.keep_classes(df, [0, 3]), labels).collect()
    assert sorted((r.doc_id, r["class"]) for r in shown) == [(1, "bail"), (2, "3")]


def test_span(spark):
    df = spark.createDataFrame([(START,), (None,), (START + timedelta(2),)], "date TIMESTAMP")
    assert tuple(timeline.corpus_span(df).first()) == (3, START, START + timedelta(2))


def test_hexagons_match_a_plain_search_for_the_nearest_centre(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 2))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x DOUBLE, y DOUBLE")
    cells = density.cell_centers(density.hexbin_counts(df)).collect()
    assert sum(c.n for c in cells) == 500
    low, high = points.min(axis=0), points.max(axis=0)
    scaled = (points - low) / (high - low) * 30 / np.array([1.0, np.sqrt(3)])
    expected = {}
    grid = [(i + s, j + s) for s in (0, 0.5) for i in range(-1, 40) for j in range(-1, 40)]
    centers = np.array([(cx, cy) for cy, cx in grid])
    for p in scaled:
        at = tuple(centers[((p - centers) ** 2 * [1, 3]).sum(axis=1).argmin()])
        expected[at] = expected.get(at, 0) + 1
    assert {(c.cx, c.cy): c.n for c in cells} == expected


def test_durable_rows_do_not_change(spark):
    frozen = durable(spark.range(10).withColumn("x", F.rand()))
    assert frozen.collect() == frozen.collect()


def test_shared_folder_is_the_one_the_session_names():
    def session(setting, master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert shared_folder(session("hdfs://nn/work/", "yarn")) == "hdfs://nn/work"
    with pytest.raises(RuntimeError):
        shared_folder(session(None, "yarn"))


@pytest.mark.parametrize("order", ["rows", "reversed"])
def test_result_does_not_depend_on_the_order_of_input(spark, order):
    rows = [(i, START + timedelta(hours=i % 7), "ab"[i % 2]) for i in range(60)]
    assert counted(spark, rows if order == "rows" else rows[::-1]) == naive(rows)


def test_time_line_shuffles_its_rows_once(spark, monkeypatch):
    """One exchange of the rows before they are frozen, none after, and no window over everything."""
    plans = []
    freeze = timeline.durable

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return freeze(df)

    monkeypatch.setattr(timeline, "durable", watched)
    rows = spark.range(500).selectExpr("id AS doc_id", "timestamp_seconds(id % 50) AS date", "CASE WHEN id % 3 > 0 THEN id % 3 END AS class")
    out = timeline.class_timeline(rows, parts=5)
    got = sorted(((r.date, r["class"] is not None, r["class"] or 0, r.doc_id, r.csum, r.total) for r in out.collect()))
    assert plans[0].count("Exchange") == 1
    assert "SinglePartition" not in plans[1]
    final = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in final and "Repartition" not in final
    seen = {}
    for i, (_, known, c, _, csum, total) in enumerate(got, 1):
        seen[known, c] = seen.get((known, c), 0) + 1
        assert (csum, total) == (seen[known, c], i)
