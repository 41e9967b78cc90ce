"""Page images made ready for reading, in numpy, and the interface of a reader; each step falls through to its input on an error."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

BLOCK, OFFSET, MIN_ANGLE, SHARPER, BLURRED, SIGMA = 11, 2.0, 0.5, 1.5, -0.5, 3.0


def grey(a: np.ndarray) -> np.ndarray:
    """Luma of an RGB image; a grey one stays."""
    return a if a.ndim == 2 else (a[..., :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])).round().astype(np.uint8)


def _blur(a: np.ndarray, sigma: float, radius: int) -> np.ndarray:
    w = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    w /= w.sum()
    for axis in (0, 1):
        pad = [(radius, radius) if k == axis else (0, 0) for k in (0, 1)]
        p = np.pad(a, pad, mode="edge")
        n = a.shape[axis]
        a = sum(w[i] * np.take(p, range(i, i + n), axis) for i in range(2 * radius + 1))
    return a


def threshold(a: np.ndarray) -> np.ndarray:
    """White where a pixel is lighter than the weighted mean of its BLOCK by BLOCK surroundings less OFFSET, else black."""
    near = _blur(a.astype(np.float64), 0.3 * ((BLOCK - 1) * 0.5 - 1) + 0.8, BLOCK // 2)
    return np.where(a > near - OFFSET, 255, 0).astype(np.uint8)


def denoise(a: np.ndarray) -> np.ndarray:
    """The median of each pixel's 3 by 3 surroundings: single specks go."""
    p = np.pad(a, 1, mode="edge")
    h, w = a.shape
    return np.median(np.stack([p[i : i + h, j : j + w] for i in range(3) for j in range(3)]), axis=0).astype(np.uint8)


def _turned(a: np.ndarray, degrees: float) -> np.ndarray:
    h, w = a.shape
    t = np.deg2rad(degrees)
    y, x = np.mgrid[:h, :w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.rint(np.cos(t) * (x - cx) + np.sin(t) * (y - cy) + cx).astype(int)
    sy = np.rint(-np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    return np.where(inside, a[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)], 255).astype(np.uint8)


def skew(a: np.ndarray, most: float = 5.0, step: float = 0.5) -> float:
    """The turn, in degrees, after which lines of dark pixels stand out most from the gaps between them."""
    angles = np.arange(-most, most + step / 2, step)
    return float(max(angles, key=lambda d: (((_turned(a, d) < 128).sum(1).astype(float)).var(), -abs(d))))


def deskew(a: np.ndarray) -> np.ndarray:
    angle = skew(a)
    return _turned(a, angle) if abs(angle) >= MIN_ANGLE else a


def sharpen(a: np.ndarray) -> np.ndarray:
    return np.clip(SHARPER * a + BLURRED * _blur(a.astype(np.float64), SIGMA, int(3 * SIGMA)), 0, 255).round().astype(np.uint8)


STEPS: tuple[Callable[[np.ndarray], np.ndarray], ...] = (grey, threshold, denoise, deskew, sharpen)


def prepare(image: np.ndarray, steps: tuple[Callable[[np.ndarray], np.ndarray], ...] = STEPS) -> np.ndarray:
    for step in steps:
        try:
            image = step(image)
        except Exception:  # noqa: BLE001
            continue
    return image


def page_reader(render: Callable[[bytes, int], np.ndarray], read: Callable[[np.ndarray], str]) -> Callable[[bytes, int], str]:
    """What `files.pdf_pages` takes as `ocr`: a page rendered, prepared, read and stripped; any error gives the empty text. Both parts are the caller's, as no such library is installed."""

    def ocr(content: bytes, page: int) -> str:
        try:
            return (read(prepare(render(content, page))) or "").strip()
        except Exception:  # noqa: BLE001
            return ""

    return ocr
