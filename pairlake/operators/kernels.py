"""Image kernels in Arrow batches: sharpness, lighting, structural similarity, head pose.

Pictures are arrays of rows (array<array<double>>) or encoded bytes. NumPy only;
PNG and PNM are decoded here, other formats if Pillow is installed.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey picture as doubles, or None where the bytes are no readable picture."""
    if not data:
        return None
    try:
        if data[:2] in (b"P5", b"P6"):
            return _pnm(data)
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        return _other(data)
    except (ValueError, IndexError, struct.error, zlib.error, OSError):
        return None


def grey(rgb: np.ndarray) -> np.ndarray:
    return np.rint(rgb[..., 0] * 0.299 + rgb[..., 1] * 0.587 + rgb[..., 2] * 0.114)


def _pnm(data: bytes) -> np.ndarray:
    parts, at = [], 2
    while len(parts) < 3:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while not data[end : end + 1].isspace():
            end += 1
        parts.append(int(data[at:end]))
        at = end
    w, h, _ = parts
    depth = 3 if data[:2] == b"P6" else 1
    raw = np.frombuffer(data, np.uint8, w * h * depth, at + 1).astype(float)
    return grey(raw.reshape(h, w, 3)) if depth == 3 else raw.reshape(h, w)


def _png(data: bytes) -> np.ndarray:
    at, body, size = 8, b"", None
    palette = None
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        kind, chunk = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
        at += 12 + n
    w, h, bits, colour, _, _, lace = size
    if bits != 8 or lace:
        raise ValueError("only 8-bit pictures without interlacing")
    depth = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * depth)
    out = np.zeros((h, w * depth), np.uint8)
    above = np.zeros(w * depth, np.int64)
    for y in range(h):
        line = raw[y, 1:].astype(np.int64)
        f = raw[y, 0]
        if f == 1:
            # each byte adds to the one a pixel before it: running sums per channel
            line = np.cumsum(line.reshape(w, depth), axis=0).reshape(-1) % 256
        elif f == 2:
            line = (line + above) % 256
        elif f:
            for x in range(len(line)):
                left = line[x - depth] if x >= depth else 0
                up, corner = above[x], above[x - depth] if x >= depth else 0
                if f == 3:
                    line[x] = (line[x] + (left + up) // 2) % 256
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    line[x] = (line[x] + (left if a <= b and a <= c else up if b <= c else corner)) % 256
        out[y], above = line, line
    px = out.reshape(h, w, depth).astype(float)
    if colour == 3:
        return grey(palette[out.reshape(h, w)].astype(float))
    return px[..., 0] if depth < 3 else grey(px)


def _other(data: bytes) -> np.ndarray | None:
    try:
        from PIL import Image
    except ImportError:
        return None
    import io

    return np.asarray(Image.open(io.BytesIO(data)).convert("L"), dtype=float)


def sharpness(g: np.ndarray) -> float:
    """Variance of the Laplacian, borders mirrored."""
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def lighting(g: np.ndarray) -> tuple[float, float]:
    """(uniformity, mean): 1 less the coefficient of variation, at least 0; 0 for a black picture."""
    mean = float(g.mean())
    return (0.0 if mean < 1e-6 else max(0.0, 1.0 - float(g.std()) / mean)), mean


def box_mean(a: np.ndarray, size: int) -> np.ndarray:
    """Mean over a window of odd size; at borders over the part inside."""
    r = size // 2

    def along(x: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
        k = np.arange(len(x))
        lo, hi = np.maximum(k - r, 0), np.minimum(k + r + 1, len(x))
        return c[hi] - c[lo]

    count = along(along(np.ones_like(a)).T).T
    return along(along(a).T).T / count


def ssim(a: np.ndarray, b: np.ndarray, size: int = 11, span: float = 2.0) -> float:
    """Mean structural similarity with a box window."""
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    ma, mb = box_mean(a, size), box_mean(b, size)
    va, vb, vab = box_mean(a * a, size) - ma * ma, box_mean(b * b, size) - mb * mb, box_mean(a * b, size) - ma * mb
    s = ((2 * ma * mb + c1) * (2 * vab + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2) + 1e-8)
    return float(s.mean())


def _grid(x) -> np.ndarray | None:
    if x is None or len(x) == 0:
        return None
    return np.stack([np.asarray(r, dtype=float) for r in x])


MEASURES = ["blur_score", "lighting_uniformity", "mean_brightness"]
# types are spelled out, as text they can't be read on executors
QUALITY = T.StructType([T.StructField(m, T.DoubleType()) for m in MEASURES] + [T.StructField(s, T.IntegerType()) for s in ("width", "height")])


def _quality(g: np.ndarray | None) -> tuple:
    if g is None:
        return None, None, None, 0, 0
    even, mean = lighting(g)
    return sharpness(g), even, mean, g.shape[1], g.shape[0]


@F.pandas_udf(QUALITY)
def quality_of_pixels(pixels: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Measures of pictures given as array<array<double>>; unreadable ones have size 0 and null measures."""
    for s in pixels:
        yield pd.DataFrame([_quality(_grid(x)) for x in s], columns=QUALITY.names)


@F.pandas_udf(QUALITY)
def quality_of_bytes(content: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Measures of encoded pictures."""
    for s in content:
        yield pd.DataFrame([_quality(decode(bytes(x) if x is not None else None)) for x in s], columns=QUALITY.names)


@F.pandas_udf(T.DoubleType())
def ssim_of_pixels(a: pd.Series, b: pd.Series) -> pd.Series:
    """Structural similarity of two pictures of one size; null where one is missing or sizes differ."""
    out = []
    for x, y in zip(a, b):
        g, h = _grid(x), _grid(y)
        out.append(ssim(g, h) if g is not None and h is not None and g.shape == h.shape else None)
    return pd.Series(out, dtype="float64")


def solve_pose(model: np.ndarray, image: np.ndarray, focal: float, centre: tuple[float, float], turns: int = 60) -> np.ndarray | None:
    """Rotation matrix that projects model points onto image points: Gauss-Newton with damping, from a frontal start."""
    x = np.array([0.0, 0.0, 0.0, 0.0, 0.0, float(np.ptp(model[:, :2]) / max(np.ptp(image), 1e-6) * focal)])

    def rotation(v: np.ndarray) -> np.ndarray:
        t = np.linalg.norm(v)
        if t < 1e-12:
            return np.eye(3)
        k = v / t
        m = np.array([[0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]])
        return np.eye(3) + np.sin(t) * m + (1 - np.cos(t)) * m @ m

    def gap(p: np.ndarray) -> np.ndarray:
        q = model @ rotation(p[:3]).T + p[3:]
        z = np.where(np.abs(q[:, 2]) < 1e-9, 1e-9, q[:, 2])
        return np.concatenate([focal * q[:, 0] / z + centre[0] - image[:, 0], focal * q[:, 1] / z + centre[1] - image[:, 1]])

    damp, e = 1e-3, gap(x)
    for _ in range(turns):
        step = 1e-6 * np.maximum(1.0, np.abs(x))
        jac = np.stack([(gap(x + step[k] * np.eye(6)[k]) - e) / step[k] for k in range(6)], axis=1)
        h = jac.T @ jac
        move = np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-9), -jac.T @ e)
        new = gap(x + move)
        if new @ new < e @ e:
            x, e, damp = x + move, new, damp / 3
            if np.abs(move).max() < 1e-10:
                break
        else:
            damp *= 4
    return rotation(x[:3]) if np.isfinite(x).all() else None


def euler(r: np.ndarray) -> tuple[float, float, float]:
    """(pitch, yaw, roll) in degrees of a rotation matrix."""
    s = float(np.hypot(r[0, 0], r[1, 0]))
    if s >= 1e-6:
        angles = np.arctan2(r[2, 1], r[2, 2]), np.arctan2(-r[2, 0], s), np.arctan2(r[1, 0], r[0, 0])
    else:
        angles = np.arctan2(-r[1, 2], r[1, 1]), np.arctan2(-r[2, 0], s), 0.0
    return tuple(float(np.degrees(a)) for a in angles)


def head_pose(model_points: list[list[float]]):
    """A function of (points array<array<double>>, width, height) that gives struct(yaw, pitch, roll); the model's points are a parameter."""
    model = np.asarray(model_points, dtype=float)

    @F.pandas_udf("yaw double, pitch double, roll double")
    def run(points: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
        out = []
        for p, w, h in zip(points, width, height):
            g = _grid(p)
            r = solve_pose(model, g, float(w), (w / 2, h / 2)) if g is not None and g.shape == (len(model), 2) else None
            pitch, yaw, roll = euler(r) if r is not None else (None, None, None)
            out.append((yaw, pitch, roll))
        return pd.DataFrame(out, columns=["yaw", "pitch", "roll"])

    return run
