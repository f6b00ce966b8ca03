"""Operators against literals worked out by hand and against Python on random bags."""

from __future__ import annotations

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tremor.operators import bags, counting, grouping, joins, matching, ranking, windows
from tremor.sources.cities import CITIES, cities
from tremor.sources.tables import number_range


def ints(spark, numbers, name="v"):
    return spark.createDataFrame([(n,) for n in numbers], f"{name} INT")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


A = [3, 8, 21, 6, 13, 40]
B = [3, 6, 12, 21, 30, 40]


def test_small_sets(spark):
    a, b = ints(spark, A), ints(spark, B)
    assert bag(bags.distinct_intersection(a, b)) == Counter({(3,): 1, (6,): 1, (21,): 1, (40,): 1})
    assert bag(bags.bag_subtract(a, b)) == Counter({(8,): 1, (13,): 1})
    assert bag(bags.bag_union(a, a)) == Counter({(n,): 2 for n in A})
    other = ints(spark, [5, 11, 17, 2, 9, 40, 11, 5, 28, 2])
    assert bag(bags.distinct_intersection(other, ints(spark, range(1, 11)))) == Counter({(2,): 1, (5,): 1, (9,): 1})
    assert other.distinct().count() == 7


def test_bags_with_nulls_and_copies(spark):
    left, right = ints(spark, [1, 1, 2, 3, None, None]), ints(spark, [2, None])
    assert bag(bags.bag_subtract(left, right)) == Counter({(1,): 2, (3,): 1})
    assert bag(bags.distinct_intersection(left, right)) == Counter({(2,): 1, (None,): 1})


def test_subtract_from_itself_drops_the_header(spark):
    lines = spark.createDataFrame([("Invoice;Qty",), ("1;2",), ("1;2",), ("Invoice;Qty",)], "value STRING")
    header = lines.where(F.col("value").contains("Invoice")).limit(1)
    assert bag(bags.bag_subtract(lines, header)) == Counter({("1;2",): 2})


def test_bags_like_python_on_random_pairs(spark):
    rng = random.Random(7)
    draw = lambda n: [(rng.choice([None, 0, 1, 2, 3]), rng.choice(["a", "b", None])) for _ in range(n)]
    for _ in range(3):
        x, y = draw(40), draw(8)
        left, right = (spark.createDataFrame(r, "k INT, s STRING") for r in (x, y))
        gone = set(y)
        assert bag(bags.bag_subtract(left, right)) == Counter(t for t in x if t not in gone)
        assert bag(bags.distinct_intersection(left, right)) == Counter(set(x) & set(y))


def test_top_and_sort(spark):
    a = ints(spark, A)
    assert [r.v for r in ranking.top_k(a, "v", 3).collect()] == [40, 21, 13]
    assert [r.v for r in ranking.top_k(a, "v", 4, descending=False).collect()] == [3, 6, 8, 13]
    assert a.agg(F.sum("v")).first()[0] == 91
    pairs = spark.createDataFrame([(1, "b"), (2, "a"), (1, "a")], "n INT, name STRING")
    ranked = ranking.sorted_by(pairs, "n", "name", descending=True).collect()
    assert [tuple(r) for r in ranked] == [(2, "a"), (1, "a"), (1, "b")]


def test_range(spark):
    bands = number_range(spark, 10, 100, 5, "band").orderBy("band").collect()
    assert [r.band for r in bands] == list(range(10, 100, 5))


def test_pair_sums_and_lists(spark):
    pairs = spark.createDataFrame([(1, 2, 0), (3, 4, 1), (3, 6, 2)], "k INT, v INT, id INT")
    assert bag(pairs.groupBy("k").agg(F.sum("v"))) == Counter({(1, 2): 1, (3, 10): 1})
    grouped = grouping.grouped_values(pairs, "k", "v", F.xxhash64("id"), 100)
    assert sorted((r.k, r.slice, r["values"]) for r in grouped.collect()) == [(1, 0, [2]), (3, 0, [4, 6])]


def test_grouped_values_split_a_frequent_key(spark):
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i}", i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k STRING, v INT, id BIGINT")
    slices = grouping.grouped_values(df, "k", "v", F.xxhash64("id"), max_values=50).collect()
    assert max(len(s["values"]) for s in slices) <= 80
    assert len([s for s in slices if s.k == "hot"]) == 6
    back = Counter((s.k, v) for s in slices for v in s["values"])
    assert back == Counter((k, v) for k, v, _ in rows)


def test_grouped_values_keep_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "b", 6), (2, None, 7)], "k INT, v STRING, id BIGINT")
    grouped = grouping.grouped_values(df, "k", "v", F.col("id"), 10).collect()
    assert {r.k: r["values"] for r in grouped} == {1: ["b", None], 2: [None]}
    unknown = spark.createDataFrame([(1, f"v{i}", None) for i in range(60)], "k INT, v STRING, id BIGINT")
    slices = grouping.grouped_values(unknown, "k", "v", F.col("id"), 10).collect()
    assert {r.slice for r in slices} == set(range(6))
    assert sorted(v for r in slices for v in r["values"]) == sorted(f"v{i}" for i in range(60))


def test_small_values_are_not_rounded_away(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert df.agg(grouping.exact_sum("v")).first()[0] == 4.0


def test_weighted_words(spark):
    df = spark.createDataFrame([("a b", 3), ("b", 2), ("a  c", 1)], "t STRING, n INT")
    words = F.split("t", " ")
    assert [tuple(r) for r in grouping.word_counts(df, words).collect()] == [("a", 2), ("b", 2), ("", 1), ("c", 1)]
    weighted = grouping.word_counts(df, words, F.col("n")).collect()
    assert [tuple(r) for r in weighted] == [("b", 5), ("a", 4), ("", 1), ("c", 1)]


def test_exact_sum_does_not_depend_on_order(spark):
    numbers = [0.1] * 1000 + [1e9] + [0.2] * 1000
    up = spark.createDataFrame([(n,) for n in numbers], "v DOUBLE")
    down = spark.createDataFrame([(n,) for n in reversed(numbers)], "v DOUBLE").repartition(7)
    assert up.agg(grouping.exact_sum("v")).first()[0] == down.agg(grouping.exact_sum("v")).first()[0] == 1000000300.0


def test_lookup_keeps_misses_and_takes_the_last_version(spark):
    totals = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 5.0)], "id INT, total DOUBLE")
    versions = [(1, "old", 1), (1, "new", 2), (2, "same", 1), (9, "same", 1)]
    names = spark.createDataFrame(versions, "id INT, name STRING, v INT")
    dimension = joins.latest_by_key(names, "id", "name", "v")
    found = joins.looked_up(totals, dimension, "id")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 10.0, "new"), (2, 20.0, "same"), (3, 5.0, None)]


def test_key_match_counts(spark):
    left = ints(spark, [1, 1, 2, None, None, 7], "k")
    right = ints(spark, [1, 1, 1, 2, 8, None], "k")
    found = joins.key_match_counts(left, right, "k").first()
    assert found.left_rows == 6 and found.right_rows == 6
    assert found.joined_rows == left.join(right, "k").count() == 7
    assert found.left_without_partner == left.join(right, "k", "left_anti").count() == 3
    assert found.right_without_partner == right.join(left, "k", "left_anti").count() == 2
    side = spark.createDataFrame([(1, 4_000_000_000)], "k INT, n BIGINT")
    huge = side.select("k", F.col("n").cast("decimal(38,0)") * F.col("n")).first()[1]
    assert int(huge) == 16 * 10**18 > 2**63
    empty = joins.key_match_counts(left.limit(0), right.limit(0), "k").first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_pairs_with_a_fixed_list(spark):
    assert joins.paired_with(ints(spark, A), B, "w").count() == len(A) * len(B)
    assert joins.paired_with(ints(spark, A), range(1500), "w").count() == len(A) * 1500


def test_city_dimension(spark):
    rows = cities(spark).orderBy("id").collect()
    assert len(rows) == len(set(CITIES)) == 81
    assert (rows[0].city, rows[33].city, rows[80].city) == ("Adana", "İstanbul", "Düzce")


def test_dimension_counts_match_whole_names_only(spark):
    facts = spark.createDataFrame([("ANKARA",), ("ANKARA",), ("ANK",), ("VAN",), (None,), ("PARIS",)], "k STRING")
    dimension = cities(spark).withColumn("key", F.upper("city"))
    counted = joins.dimension_counts(facts, dimension, "k", "key", "id")
    assert {r.city: r.n for r in counted.collect() if r.n} == {"Ankara": 2, "Van": 1}
    assert counted.count() == 81


def test_exact_sum_of_tiny_huge_and_odd_values(spark):
    def total(values):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        return frame.repartition(3).agg(grouping.exact_sum("v")).first()[0]

    assert spark.range(1_000_000).select(F.lit(4e-11).alias("v")).agg(grouping.exact_sum("v")).first()[0] == pytest.approx(4e-5, rel=1e-12)
    rng = random.Random(4)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-25, 24) for _ in range(3000)]
    assert total(values) == pytest.approx(math.fsum(values), rel=1e-15)
    assert total(values) == total(values[::-1])
    assert total([1e20, 1.0, -1e20]) == 1.0
    assert total([1e300, 1.0]) == 1e300
    assert total([math.inf, 1.0]) == math.inf and math.isnan(total([math.nan, 1.0]))
    assert total([None, None]) is None and total([]) is None and total([None, 2.5]) == 2.5


def test_latest_by_key_with_ties_and_nulls(spark):
    rows = [("a", 1, 5), ("a", 2, 3), ("a", 2, 9), ("b", None, 7), ("c", None, 1), ("c", 0, 2), ("d", 4, None), (None, 1, 8)]
    frame = spark.createDataFrame(rows, "k string, v int, x int")
    assert bag(joins.latest_by_key(frame, "k", "x", "v")) == Counter([("a", 9), ("b", 7), ("c", 2), ("d", None), (None, 8)])


def test_running_totals_like_a_window(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, None]), k // 3, rng.choice([None, rng.randint(-500, 500) / 4])) for k in range(900)]
    frame = spark.createDataFrame(rows, "a int, b int, v double").repartition(5)
    found = ranking.running_totals(frame, ["a", "b"], "v").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 901))
    found.sort(key=lambda r: r["rank"])
    keys = [((r.a is not None, r.a or 0), r.b) for r in found]
    assert keys == sorted(keys)
    total = 0
    for r in found:
        total += r.v or 0
        assert float(r.running) == total
    assert ranking.running_totals(frame.limit(0), ["a"], "v").collect() == []


def test_running_totals_meet_in_no_single_task(spark):
    frame = spark.range(2000).selectExpr("id % 3 AS a", "id", "1.5 AS v")
    plan = ranking.running_totals(frame, ["a", "id"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A third of the rows in one value of the first column still spreads over the ranges.
    same = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit(1.0).alias("v"))
    assert ranking.running_totals(same, ["a"], "v").agg(F.max("rank")).first()[0] == 3000


TEXTS = ["", None, "abcabc", "İzmir'de deprem", "de", "x" * 5000 + "needle", "aaa", "a\nb", "\U0001f600 smile", "ab"]
NAMES = ["abc", "a", "ab", "", None, "deprem", "needle", "İzmir", "\U0001f600", "\nb", "aaaa", "zz", "xn", "ire"]


@pytest.mark.parametrize("few", [0, 300_000])
def test_contained_names(spark, monkeypatch, few):
    monkeypatch.setattr(matching, "BROADCAST_ROWS", few)
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "key bigint, text string")
    names = spark.createDataFrame(list(enumerate(NAMES)), "name_id bigint, name string")
    found = matching.contained_names(texts, names)
    expected = Counter((k, n) for k, t in enumerate(TEXTS) for n, name in enumerate(NAMES) if t and name and name in t)
    assert bag(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert matching.contained_names(texts.limit(0), names).collect() == []
    assert matching.contained_names(texts, names.limit(0)).collect() == []


def test_contained_names_of_one_frequent_run(spark):
    """A third of all texts holds a run; names that have it are listed under another one."""
    texts = spark.range(3000).selectExpr("id AS key", "if(id % 3 = 0, concat('common', id), concat('rare', id)) AS text")
    names = spark.createDataFrame([(1, "common12"), (2, "mmon"), (3, "rare1")], "name_id bigint, name string")
    found = Counter(r.name_id for r in matching.contained_names(texts, names).collect())
    ids = range(3000)
    assert found == Counter({
        1: sum(k % 3 == 0 and str(k).startswith("12") for k in ids), 2: 1000, 3: sum(k % 3 != 0 and str(k).startswith("1") for k in ids),
    })


def test_contained_names_of_shared_runs(spark, monkeypatch):
    """Every run of three characters of every name is in every text; still a text meets only the names it contains."""
    digits = [f"{k:03}" for k in range(1000)]
    filler = " ".join(digits)
    texts = spark.createDataFrame([(k % 7, f"{filler} #{k:04}# {filler}") for k in range(200)], "key int, text string")
    names = spark.createDataFrame([(k, f" #{k:04}# 000 001 002") for k in range(100, 400)], "name_id int, name string")
    monkeypatch.setattr(windows, "_PIECE", 1500)  # texts are cut into overlapping pieces
    shared = matching._name_filter(names.select(F.col("name").cast("binary").alias("_name")))
    found = [s for own in shared.candidates(pa.array([r.text for r in texts.collect()])) for s in own[1]]
    assert 100 <= len(found) <= 110
    assert bag(matching.contained_names(texts, names)) == Counter((k % 7, k) for k in range(100, 200))


def test_contained_names_like_a_search(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(windows, "_PIECE", 64)
    word = lambda most: "".join(rng.choice("aabé ") for _ in range(rng.randrange(most)))
    texts, names = [word(200) for _ in range(60)], [word(14) for _ in range(150)]
    expected = Counter((k, n) for k, t in enumerate(texts) for n, name in enumerate(names) if name and name in t)
    found = matching.contained_names(
        spark.createDataFrame(list(enumerate(texts)), "key int, text string"),
        spark.createDataFrame(list(enumerate(names)), "name_id int, name string"),
    )
    assert bag(found) == expected


def test_points_in_boxes_on_cell_borders(spark):
    rng = random.Random(8)
    near = lambda: rng.choice([-20, -10, 0, 10, 20, rng.uniform(-25, 25), None])
    points = [(k, *(None if v is None else float(v) for v in (near(), near()))) for k in range(150)]
    boxes = [(k, *(None if v is None else float(v) for v in (near(), near(), near(), near()))) for k in range(120)]
    found = matching.points_in_boxes(
        spark.createDataFrame(points, "p int, lon double, lat double"),
        spark.createDataFrame(boxes, "b int, west double, south double, east double, north double"),
    )
    expected = Counter(
        (p, b) for p, x, y in points for b, west, south, east, north in boxes
        if None not in (x, y, west, south, east, north) and west <= x <= east and south <= y <= north
    )
    assert Counter((r.p, r.b) for r in found.collect()) == expected and expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_counts_in_boxes_like_a_search(spark, monkeypatch):
    monkeypatch.setattr(counting, "STRIP_POINTS", 5)
    monkeypatch.setattr(counting, "STRIPS", 9)
    monkeypatch.setattr(counting, "STRIP_CORNERS", 20)  # strips are shared by tasks
    rng = random.Random(11)
    place = lambda: rng.choice([None, -0.0, 0.0, 1.0, 2.0, rng.uniform(-3, 3), rng.uniform(-3, 3)])
    layer = lambda: (rng.choice("ab"), rng.choice([None, "t", "u"]))
    points = [(*layer(), place(), place(), rng.randint(1, 4)) for _ in range(300)]
    boxes = [(k // 2, *layer(), place(), place(), place(), place(), rng.choice([1, 1, -1])) for k in range(160)]
    found = counting.counts_in_boxes(
        spark.createDataFrame(points, "l string, m string, lon double, lat double, n int"),
        spark.createDataFrame(boxes, "box_id int, l string, m string, west double, south double, east double, north double, sign int"),
        ["l", "m"],
    )
    expected = Counter()
    for box, *own, west, south, east, north, sign in boxes:
        for *at, x, y, n in points:
            if at == own and None not in (x, y, west, south, east, north) and west <= x <= east and south <= y <= north:
                expected[box] += sign * n
    assert {r.box_id: r.n for r in found.collect()} == {k: n for k, n in expected.items() if n}


def test_subscription_counts_equal_the_pairs(spark):
    rng = random.Random(12)
    words = ["sel", "deprem", "yangın", "de", "", None]
    side = lambda: rng.choice([None, *map(float, range(-4, 5))])
    messages = spark.createDataFrame(
        [(k // 2, rng.choice(["tr", "en", None]), side(), side(), rng.choice([None, "deprem sel", "yangın de", "x"])) for k in range(240)],
        "key int, lang string, lon double, lat double, text string",
    )
    subscriptions = spark.createDataFrame(
        [(k, rng.choice(["tr", "en", None]), side(), side(), side(), side(), rng.choice(words)) for k in range(150)],
        "sub_id int, language string, west double, south double, east double, north double, term string",
    )
    pairs = matching.subscription_matches(messages, subscriptions)
    found = matching.subscription_matches(messages, subscriptions, counted=True)
    expected = Counter()
    for m in messages.collect():
        for s in subscriptions.collect():
            box = None not in (m.lon, m.lat, s.west, s.south, s.east, s.north)
            box = box and s.west <= m.lon <= s.east and s.south <= m.lat <= s.north
            if m.lang and m.lang == s.language and (box or (s.term and m.text and s.term in m.text)):
                expected[s.sub_id] += 1
    assert Counter(r.sub_id for r in pairs.collect()) == expected
    assert {r.sub_id: r.n for r in found.collect()} == expected


def test_subscription_counts_make_no_pairs(spark):
    """Two thousand messages that two thousand subscriptions want make four million pairs, but few rows."""
    messages = spark.range(2000).selectExpr("id AS key", "'tr' AS lang", "id * 0.001D AS lon", "id * 0.002D AS lat", "concat('deprem ', id) AS text")
    subscriptions = spark.range(2000).selectExpr(
        "id AS sub_id", "'tr' AS language", "-1.0D AS west", "-1.0D AS south", "1.0D AS east", "9.0D AS north", "'depr' || if(id % 2 = 0, 'em', 'e') AS term"
    )
    counts = matching.subscription_matches(messages, subscriptions, counted=True)
    assert counts.groupBy("n").count().collect() == [(2000, 2000)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
