"""Small images for tests, as DataFrames and as arrays."""

import numpy as np
from pyspark.sql import functions as F


def image(spark, array: np.ndarray, texture_id: int = 0, sized: bool = False):
    """DataFrame of an array of shape (height, width, 4)."""
    h, w, _ = array.shape
    rows = [(texture_id, y, x, *map(float, array[y, x])) for y in range(h) for x in range(w)]
    df = spark.createDataFrame(rows, "texture_id long, y int, x int, r double, g double, b double, a double")
    return df.withColumns({"width": F.lit(w), "height": F.lit(h)}) if sized else df


def to_array(df, channels="rgba") -> np.ndarray:
    pdf = df.select("y", "x", *channels).toPandas()
    out = np.full((pdf.y.max() + 1, pdf.x.max() + 1, len(channels)), np.nan)
    out[pdf.y, pdf.x] = pdf[list(channels)].to_numpy()
    assert len(pdf) == out.shape[0] * out.shape[1]
    return out


def random_image(height: int, width: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).random((height, width, 4))


def kernel(name: str, u: np.ndarray) -> np.ndarray:
    d = np.abs(u)
    if name == "triangle":
        return np.maximum(0, 1 - d)
    if name == "mitchell":
        b = c = 1 / 3
        near = ((12 - 9 * b - 6 * c) * d**3 + (-18 + 12 * b + 6 * c) * d**2 + 6 - 2 * b) / 6
        far = ((-b - 6 * c) * d**3 + (6 * b + 30 * c) * d**2 + (-12 * b - 48 * c) * d + 8 * b + 24 * c) / 6
        return np.where(d < 1, near, np.where(d < 2, far, 0))
    return np.where(d < 3, np.sinc(u) * np.i0(4 * np.sqrt(np.maximum(0, 1 - (u / 3) ** 2))) / np.i0(4), 0)


SUPPORT = {"triangle": 1, "mitchell": 2, "kaiser": 3}


def axis_weights(name: str, n: int, out: int, wrap: str) -> np.ndarray:
    """Matrix (out, n) of normalised weights, gathered tap by tap."""
    s = n / out
    weights = np.zeros((out, n))
    for d in range(out):
        if name == "box":
            for i in range(n):
                weights[d, i] = max(0, min((i + 1) * out, (d + 1) * n) - max(i * out, d * n))
        else:
            reach = int(np.ceil(SUPPORT[name] * max(1, s))) + 2
            for j in range(int(d * s) - reach, int((d + 1) * s) + reach + 1):
                u = ((j + 0.5) / s - 0.5 - d) * min(1, s)
                i = min(n - 1, max(0, j)) if wrap == "clamp" else j % n
                weights[d, i] += float(kernel(name, np.array(u)))
    return weights / weights.sum(axis=1, keepdims=True)


def resized(array: np.ndarray, width: int, height: int, name: str, wrap: str = "clamp") -> np.ndarray:
    h, w, _ = array.shape
    return np.einsum("dy,yxc,ex->dec", axis_weights(name, h, height, wrap), array, axis_weights(name, w, width, wrap))
