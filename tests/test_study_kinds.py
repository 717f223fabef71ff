import random

import numpy as np
from pyspark.ml.linalg import Vectors

from affinia.operators import boosting
from affinia.operators.forests import trees_of


def binned(spark):
    rng = random.Random(4)
    rows = [(float(rng.random() > 0.5), i % 3, Vectors.dense([float(rng.randrange(5)), float(rng.random() > 0.5)])) for i in range(600)]
    df = spark.createDataFrame(rows, ["label", "fold", "features"])
    edges = boosting.quantiles(df)
    return boosting.binned(df, [e[:-1] for e in edges]), edges


def test_rows_of_equal_bins_are_one_kind_whatever_label_and_fold(spark):
    rows, edges = binned(spark)
    block = boosting.whole_block(rows, 1)
    assert len(block.kinds) == 10 < len(block.bins) and (block.kinds[block.of] == block.bins).all()
    n0, n1 = block.weights(np.array([0, 1, 2]))
    assert (n0 + n1).sum(axis=0).tolist() == [400, 400, 400]
    assert boosting.fits_one_block(rows, 2, 4 * len(block.bins)) and not boosting.fits_one_block(rows, 2, 4 * len(block.bins) - 1)


def test_a_tree_sees_kinds_by_whole_numbers(spark):
    rows, edges = binned(spark)
    block = boosting.whole_block(rows, 1)
    for best_cuts in (False, True):
        grown = trees_of(rows, edges, [2], best_cuts)
        sums = np.array(list(grown.seen(block, 1, range(40))))
        assert sums.shape == (40, 10, 2) and (sums == np.round(sums)).all()
        assert abs(sums.sum(axis=(1, 2)).mean() - 400) < (20 if best_cuts else 1e-9)


def test_bins_beside_the_first_are_the_rest_of_a_histogram():
    kinds = np.array([[0, 1], [2, 0], [0, 0]], np.uint8)
    first, many, place = boosting._entries(kinds, np.array([0, 3, 5]))
    assert first.tolist() == [0, 1, 2] and many.tolist() == [1, 1, 0] and place.tolist() == [4, 2]
