"""The byte network against plain loops, and row keys over folders with equal file names."""

import shutil

import numpy as np

from loanloom.llm.language import FILTERS, WIDTHS, ByteNetwork
from loanloom.llm.shared import small_batches, with_row_key


def plain(network, window):
    """Every filter at every place, its maximum cut at zero, and a softmax: one window, loop by loop."""
    hidden = []
    for width, table, bias in zip(WIDTHS, network.tables, network.bias, strict=True):
        for f in range(FILTERS):
            sums = [sum(float(table[j, window[at + j], f]) for j in range(width)) for at in range(len(window) - width + 1)]
            hidden.append(max(0.0, max(sums) + float(bias[f])))
    out = np.array(hidden) @ network.out.astype(float) + network.out_bias
    e = np.exp(out - out.max())
    return e / e.sum()


def made(seed=3):
    rng = np.random.default_rng(seed)
    network = ByteNetwork.new(["a", "b", "c"])
    for bias in network.bias:
        bias += rng.normal(0, 0.2, bias.shape).astype(np.float32)
    windows = rng.integers(1, 256, (6, 40)).astype(np.uint8)
    windows[1, 25:] = 0
    return network, windows, rng


def test_prediction_equals_plain_loops():
    network, windows, _ = made()
    found = network.predict(windows)
    for row, window in zip(found, windows, strict=True):
        assert np.allclose(row, plain(network, window), atol=1e-5)


def test_gradients_equal_differences():
    network, windows, rng = made(5)
    target = np.array([0, 1, 2, 0, 1, 2])
    loss = lambda: -float(np.mean([np.log(plain(network, w)[t]) for w, t in zip(windows, target, strict=True)]))
    for gradient, weight in zip(network.gradients(windows, target)[len(WIDTHS):], network.weights[len(WIDTHS):], strict=True):
        for _ in range(3):
            at = tuple(int(rng.integers(0, n)) for n in weight.shape)
            held, step = weight[at], 1e-3  # small, so that no maximum moves to another place
            weight[at] = held + step
            up, above = loss(), float(weight[at])
            weight[at] = held - step
            down, below = loss(), float(weight[at])
            weight[at] = held
            assert abs((up - down) / (above - below) - gradient[at]) < 1e-3


def test_row_keys_over_folders_with_equal_file_names(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next((tmp_path / "one").glob("part-*"))
    for day in ("1", "2"):
        (tmp_path / "t" / f"day={day}").mkdir(parents=True)
        shutil.copy(part, tmp_path / "t" / f"day={day}" / part.name)
    keyed = with_row_key(spark.read.parquet(str(tmp_path / "t")))
    assert keyed.select("__file", "__row").distinct().count() == 10


def test_small_batches_are_set_back(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, "1m"):
        assert spark.conf.get(name) == "1m"
    assert spark.conf.get(name) == before
