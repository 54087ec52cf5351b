"""Image kernels on batches of frames, uint8 (n, height, width, channels)."""

from __future__ import annotations

import numpy as np

# Luma weights of the usual 8-bit grey conversion (16-bit fixed point), blob sizes at 640 x 480, darkness below the 5th percentile.
LUMA = (19595, 38470, 7471)
BLOB_AREA, BLOB_OFFSET, BLOB_SCALE = (30, 400), 12, 480 * 640


def luma(rgb: np.ndarray) -> np.ndarray:
    """Weighted grey, rounded to uint8; one channel is taken as it is."""
    if rgb.shape[-1] == 1:
        return rgb[..., 0]
    r, g, b = (rgb[..., i].astype(np.uint32) for i in range(3))
    return ((r * LUMA[0] + g * LUMA[1] + b * LUMA[2] + 0x8000) >> 16).astype(np.uint8)


def centre(frames: np.ndarray, mode: str = "quarter") -> np.ndarray:
    """The central half of each frame, cut before anything is computed. 'quarter': from a quarter to three quarters of each side; 'trim': the same number of pixels off both ends."""
    h, w = frames.shape[1:3]
    if mode == "quarter":
        return frames[:, h // 4 : 3 * h // 4, w // 4 : 3 * w // 4]
    if mode == "trim":
        top, left = int(h * 0.25), int(w * 0.25)
        return frames[:, top : h - top, left : w - left]
    raise ValueError(f"unknown crop {mode!r}")


def grey_centre(frames: np.ndarray, grey: str = "mean", crop: str = "quarter") -> np.ndarray:
    """float32 (n, h/2, w/2): grey of the centre, by channel mean or luma; frames without channels pass as they are."""
    if frames.ndim == 3:
        return centre(frames, crop).astype(np.float32)
    cut = centre(frames, crop)
    return luma(cut).astype(np.float32) if grey == "luma" else cut.mean(axis=3, dtype=np.float32)


def contact(grey: np.ndarray, base: np.ndarray, thresh: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """Area (pixels that differ by more than thresh) and intensity (their mean difference, 0 if none) of each frame."""
    d = np.abs(grey.astype(np.float64) - base)
    hit = d > thresh
    area = hit.sum(axis=(1, 2))
    return area, np.where(area > 0, (d * hit).sum(axis=(1, 2)) / np.maximum(area, 1), 0.0)


def channel_lead(rgb: np.ndarray) -> np.ndarray:
    """Mean of the first channel less mean of the last."""
    return rgb[..., 0].mean(axis=(1, 2)) - rgb[..., -1].mean(axis=(1, 2))


def order_channels(rgb: np.ndarray, mode: str) -> np.ndarray:
    """Frames in the wanted channel order: 'rgb' stays, 'bgr' is reversed, 'auto' and 'mixed' are reversed where the first channel leads."""
    if mode not in ("rgb", "bgr", "auto", "mixed"):
        raise ValueError(f"unknown channel mode {mode!r}")
    if mode == "rgb" or rgb.shape[-1] == 1:
        return rgb
    turn = np.ones(len(rgb), bool) if mode == "bgr" else channel_lead(rgb) > 0
    return np.where(turn[:, None, None, None], rgb[..., ::-1], rgb)


def near_black(rgb: np.ndarray, below: float = 10.0) -> np.ndarray:
    return rgb.mean(axis=(1, 2, 3)) < below


def turn_right(frames: np.ndarray) -> np.ndarray:
    """A quarter turn clockwise."""
    return np.rot90(frames, k=-1, axes=(1, 2))


def _lanczos(size: int, to: int) -> np.ndarray:
    """Weights (to, size) of a three-lobed sinc filter, widened when shrinking."""
    scale = size / to
    reach = 3 * max(scale, 1.0)
    out = np.zeros((to, size))
    for i in range(to):
        middle = (i + 0.5) * scale
        at = np.arange(max(int(middle - reach + 0.5), 0), min(int(middle + reach + 0.5), size))
        x = (at + 0.5 - middle) / max(scale, 1.0)
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
        out[i, at] = w / w.sum()
    return out


def shrink(grey: np.ndarray, to: int = 32) -> np.ndarray:
    """uint8 (n, to, to), rows first resampled, then columns, each pass rounded to 8 bits."""
    h, w = grey.shape[1:]
    rounded = lambda x: np.clip(np.floor(x + 0.5), 0, 255)
    return rounded(_lanczos(h, to) @ rounded(grey.astype(np.float64) @ _lanczos(w, to).T)).astype(np.uint8)


def phash(rgb: np.ndarray) -> np.ndarray:
    """int64 perceptual hashes: the 8 x 8 low frequencies of the 32 x 32 grey picture against their median without the first; first bit highest.

    The transform along the last axis extends each row by the row of the upside-down
    picture, not by its own mirror image: for frequency k that adds the cosines
    of the flipped picture with the sign of (-1)^k.
    """
    a = shrink(luma(rgb)).astype(np.float64)
    j = np.arange(32)
    cosines = np.cos(np.pi * np.outer(j, j) / 32)
    signs = np.where(j % 2, -1.0, 1.0)
    along = lambda x: x @ cosines + (x[:, ::-1] @ cosines) * signs
    low = along(along(a).transpose(0, 2, 1)).transpose(0, 2, 1)[:, :8, :8].reshape(len(a), 64)
    bits = low > np.median(low[:, 1:], axis=1, keepdims=True)
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).ravel().view(np.int64)


def blobs(mask: np.ndarray) -> np.ndarray:
    """Sizes of the 4-connected components of a mask, by labels that shrink to the smallest in reach."""
    h, w = mask.shape
    label = np.where(mask, np.arange(h * w).reshape(h, w), h * w)
    while True:
        low = label.copy()
        low[1:] = np.minimum(low[1:], label[:-1])
        low[:-1] = np.minimum(low[:-1], label[1:])
        low[:, 1:] = np.minimum(low[:, 1:], label[:, :-1])
        low[:, :-1] = np.minimum(low[:, :-1], label[:, 1:])
        low = np.where(mask, low, h * w)
        flat = np.append(low.ravel(), h * w)
        low = np.where(mask, np.minimum(low, flat[low]), h * w)  # a pointer jump
        if (low == label).all():
            return np.unique(label[mask], return_counts=True)[1]
        label = low


def marker_dots(mean_image: np.ndarray) -> tuple[int, int]:
    """(dots of marker size, all dark blobs) of a mean grey image; sizes are scaled to 640 x 480."""
    sizes = blobs(mean_image < np.percentile(mean_image, 5) - BLOB_OFFSET)
    scale = mean_image.size / BLOB_SCALE
    low, high = (int(a * scale) for a in BLOB_AREA)
    return int(((sizes >= low) & (sizes <= high)).sum()), len(sizes)


def histogram(rgb: np.ndarray, bins: int = 64) -> np.ndarray:
    """int64 (channels, bins) over [0, 256)."""
    return np.stack([np.bincount(rgb[..., c].ravel() // (256 // bins), minlength=bins) for c in range(rgb.shape[-1])])


def encode_jpeg(rgb: np.ndarray, quality: int = 92) -> bytes:
    """Needs Pillow, which is optional."""
    try:
        from PIL import Image
    except ImportError as e:
        raise RuntimeError("encoding JPEG needs Pillow; PNG does not") from e
    import io

    out = io.BytesIO()
    Image.fromarray(rgb).save(out, format="JPEG", quality=quality)
    return out.getvalue()
