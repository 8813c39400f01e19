
import math

import numpy as np
import pytest

from triagelake.operators import metrics, portfolio, selection, thresholds


def frame(spark, labels, scores):
    return spark.createDataFrame(list(zip(range(len(labels)), labels, map(float, scores))), "id long, y int, s double")


@pytest.mark.parametrize("n, seed", [(1, 0), (7, 1), (40, 2), (333, 3)])
def test_shares_gains_and_deciles_by_sorting(spark, n, seed):
    draw = np.random.default_rng(seed)
    labels, scores = draw.integers(0, 2, n).tolist(), (draw.integers(0, 9, n) / 8).tolist()  # many ties
    df = frame(spark, labels, scores)
    ranked = [labels[i] for i in sorted(range(n), key=lambda i: (-scores[i], i))]
    total = sum(ranked)
    for r in portfolio.capacity_summary(df, "s", "y", "id", (0.5, 3, 20, 55, 100)).collect():
        k = min(n, max(1, math.ceil(n * r["percentage"] / 100)))
        hits = sum(ranked[:k])
        assert (r["claims_reviewed"], r["fraud_selected"], r["total_fraud"]) == (k, hits, total)
        assert r["precision"] == pytest.approx(hits / k) and r["fraud_capture"] == pytest.approx(hits / total if total else 0)
        assert r["lift"] == pytest.approx(hits / k / (total / n) if total else 0)
    gains = portfolio.cumulative_gains(df, "s", "y", "id", (10, 100)).orderBy("percentage").collect()
    assert [g["fraud_selected"] for g in gains] == [sum(ranked[:max(1, math.ceil(n / 10))]), total]
    rows = portfolio.lift_by_decile(df, "s", "y", "id").orderBy("decile").collect()
    assert [r["claims"] for r in rows] == [sum(math.ceil(rank * 10 / n) == d for rank in range(1, n + 1)) for d in range(1, 11)]
    assert [r["fraud_cases"] for r in rows] == [sum(ranked[rank - 1] for rank in range(1, n + 1) if math.ceil(rank * 10 / n) == d) for d in range(1, 11)]


def test_few_rows_leave_empty_deciles(spark):
    rows = portfolio.lift_by_decile(frame(spark, [1, 0, 0], [3, 2, 1]), "s", "y", "id").orderBy("decile").collect()
    assert [r["claims"] for r in rows] == [0, 0, 0, 1, 0, 0, 1, 0, 0, 1]
    assert rows[3]["fraud_cases"] == 1 and rows[0]["lift"] == 0.0


def test_no_positives(spark):
    r = portfolio.top_k_metrics(frame(spark, [0, 0], [1, 2]), "s", "y", "id", 50).first()
    assert r["fraud_capture"] == 0.0 and r["lift"] == 0.0


def test_published_tables(spark):
    """2,313 rows with 138 positives placed so that all published counts hold."""
    per_decile = [45, 29, 20, 17, 20, 1, 3, 1, 2, 0]
    ends = [d * 2313 // 10 for d in range(11)]
    hits = set(range(1, 13)) | set(range(25, 40)) | set(range(117, 135))  # 12, 27 and 45 in the first decile
    for d in range(1, 10):
        hits |= set(range(ends[d] + 2, ends[d] + 2 + per_decile[d]))
    labels = [int(i in hits) for i in range(1, 2314)]
    df = frame(spark, labels, [1 - i / 2313 for i in range(2313)])
    deciles = portfolio.lift_by_decile(df, "s", "y", "id").orderBy("decile").collect()
    # Published decile table of the boosted model.
    assert [r["claims"] for r in deciles] == [231, 231, 231, 232, 231, 231, 232, 231, 231, 232]
    assert [r["fraud_cases"] for r in deciles] == per_decile
    assert [round(r["lift"], 4) for r in deciles] == [3.2651, 2.1042, 1.4512, 1.2282, 1.4512, 0.0726, 0.2167, 0.0726, 0.1451, 0.0]
    got = [(r["claims_reviewed"], r["fraud_selected"], round(r["fraud_capture"], 4), round(r["precision"], 4), round(r["lift"], 4))
           for r in portfolio.capacity_summary(df, "s", "y", "id").orderBy("percentage").collect()]
    assert got == [(24, 12, 0.0870, 0.5, 8.3804), (116, 27, 0.1957, 0.2328, 3.9012),
                   (232, 45, 0.3261, 0.1940, 3.2510), (463, 74, 0.5362, 0.1598, 2.6788)]
    gains = portfolio.cumulative_gains(df, "s", "y", "id").orderBy("percentage").collect()
    assert [g["claims_reviewed"] for g in gains] == [24, 116, 232, 463, 694, 1157, 2313]


@pytest.mark.parametrize("total,share", [(0, 10), (10, 0), (10, 101), (-1, 5)])
def test_bad_review_shares(total, share):
    with pytest.raises(ValueError):
        portfolio.top_k_count(total, share)


def test_unpaired_scores_are_an_error(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "id long, y int")
    scores = spark.createDataFrame([(1, 0.5), (3, 0.5)], "id long, s double")
    with pytest.raises(Exception, match="different rows"):
        portfolio.paired_scores(labels, scores, "id").collect()


# Published confusion counts with accuracy, precision, recall and F1.
PUBLISHED = [
    (1785, 390, 64, 74, 0.8037, 0.1595, 0.5362, 0.2458), (1383, 792, 18, 120, 0.6498, 0.1316, 0.8696, 0.2286),
    (1783, 392, 66, 72, 0.8020, 0.1552, 0.5217, 0.2392), (1798, 377, 64, 74, 0.8093, 0.1641, 0.5362, 0.2513),
    (1768, 407, 72, 66, 0.7929, 0.1395, 0.4783, 0.2160), (1846, 329, 78, 60, 0.8240, 0.1542, 0.4348, 0.2277),
    (1819, 356, 68, 70, 0.8167, 0.1643, 0.5072, 0.2482), (1821, 354, 83, 55, 0.8111, 0.1345, 0.3986, 0.2011),
]


def test_published_ratios(spark):
    df = spark.createDataFrame([r[:4] for r in PUBLISHED], "tn long, fp long, fn long, tp long")
    values = metrics.ratios_from_counts()
    for row, expected in zip(df.select(*[values[m] for m in ("accuracy", "precision", "recall", "f1")]).collect(), PUBLISHED):
        assert tuple(round(v, 4) for v in row) == expected[4:]


def test_empty_ratios_are_zero(spark):
    r = metrics.evaluate(frame(spark, [1, 0], [.1, .2]), "s", "y", 0.9).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0) and (r["tn"], r["fn"]) == (1, 1)


def test_threshold_comes_from_validation(spark):
    validation = frame(spark, [0, 0, 1, 1], [.05, .20, .35, .40])
    test = frame(spark, [0, 1, 0, 1], [.10, .30, .25, .45])
    r = thresholds.evaluate_at_validation_threshold(validation, test, "s", "y").first()
    assert r["threshold"] != 0.40 and r["tn"] + r["fp"] == 2 and r["fn"] + r["tp"] == 2
    assert r["threshold"] == thresholds.SEARCH_GRID[11]  # first point above .20


def test_recall_takes_the_first_grid_point(spark):
    df = frame(spark, [0, 1] * 5, [i / 10 for i in range(10)])
    assert thresholds.best_threshold(df, "s", "y", "recall").first()["threshold"] == 0.10
    assert thresholds.best_threshold(df, "s", "y", "anything").first()["threshold"] == 0.10


def test_grid_values():
    assert len(thresholds.SEARCH_GRID) == 81
    assert thresholds.SEARCH_GRID[14] == 0.23999999999999994 and thresholds.SEARCH_GRID[-1] == 0.8999999999999996
    assert len(thresholds.PLOT_GRID) == 80


def test_empty_input_keeps_the_default_threshold(spark):
    assert thresholds.best_threshold(frame(spark, [], []), "s", "y").first()["threshold"] == 0.5


def test_scores_on_grid_points_count_as_flagged(spark):
    df = frame(spark, [1] * 81, thresholds.SEARCH_GRID)
    rows = thresholds.grid_counts(df, "s", "y", thresholds.SEARCH_GRID).orderBy("grid_index").collect()
    assert [r["tp"] for r in rows] == list(range(81, 0, -1))


def test_winner_order(spark):
    rows = [("a", 0, .20, .90, .90), ("b", 1, .30, .10, .10), ("c", 2, .30, .20, .90), ("d", 3, .30, .20, .90)]
    df = spark.createDataFrame(rows, "candidate_id string, o int, validation_pr_auc double, validation_f1 double, validation_roc_auc double")
    assert selection.require_winner(df, "o").first()["candidate_id"] == "c"
    with pytest.raises(ValueError):
        selection.require_winner(df.limit(0), "o")


def test_append_keeps_earlier_columns(spark):
    table = spark.createDataFrame([("a", 1.0)], "model string, f1 double")
    row = spark.createDataFrame([("b", 7)], "model string, other int")
    got = selection.append_result(table, row)
    assert got.columns == ["model", "f1"] and [tuple(r) for r in got.collect()] == [("a", 1.0), ("b", None)]
