"""Checks on the driver before anything is read: paths, contents, sizes."""

from __future__ import annotations

import os
from pathlib import Path

LARGEST_MB, FREE_MB, FACTOR, SHARE = 500, 256, 3.5, 0.7
STREAM_MB = 100


def check_path(path: str, *, extensions: tuple[str, ...] | None = None, root: str | None = None, must_exist: bool = True, allow_up: bool = False) -> Path:
    """The resolved path, or an error that says why not: type, empty, `..`, symbolic link, boundary, extension, existence."""
    if not isinstance(path, (str, Path)):
        raise TypeError("a path is text")
    if not str(path).strip():
        raise ValueError("the path is empty")
    if ".." in Path(path).parts and not allow_up:
        raise ValueError("the path goes up")
    p = Path(path)
    if p.is_symlink():
        raise ValueError("the path is a symbolic link")
    p = p.resolve()
    if root is not None and not p.is_relative_to(Path(root).resolve()):
        raise ValueError("the path leaves its folder")
    if extensions and p.suffix.lower() not in extensions:
        raise ValueError(f"the extension is none of {', '.join(extensions)}")
    if must_exist:
        if not p.exists():
            raise FileNotFoundError(str(p))
        if not os.access(p, os.R_OK):
            raise PermissionError(str(p))
    return p


def check_text(text: str) -> str:
    if not isinstance(text, str):
        raise TypeError("content is text")
    if not text.strip():
        raise ValueError("the content is empty")
    return text


def check_prefix(prefix: int) -> int:
    if isinstance(prefix, bool) or not isinstance(prefix, int):
        raise TypeError("an id prefix is a whole number")
    if prefix < 0:
        raise ValueError("an id prefix is not negative")
    return prefix


def memory_allows(size_mb: float, free_mb: float, *, force: bool = False) -> tuple[bool, str]:
    """Whether a document of that size could be parsed by one process; partitioned sources need no such guard."""
    if force:
        return True, "forced"
    if size_mb > LARGEST_MB:
        return False, f"{size_mb:.0f} MB is over {LARGEST_MB} MB"
    if free_mb < FREE_MB:
        return False, f"only {free_mb:.0f} MB are free"
    if size_mb * FACTOR > free_mb * SHARE:
        return False, f"{size_mb * FACTOR:.0f} MB are needed and {free_mb:.0f} MB are free"
    return True, "enough memory"


def streams_for_memory(size_bytes: int, limit_mb: float) -> bool:
    """Whether a pipeline of that memory limit takes an input in chunks: over a quarter of it."""
    return size_bytes > limit_mb * (1 << 20) / 4


def should_stream(size_mb: float, threshold_mb: float = STREAM_MB) -> bool:
    return size_mb > threshold_mb
