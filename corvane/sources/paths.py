"""Path guards for the driver's own files."""

from __future__ import annotations

import os
from pathlib import Path


class UnsafePath(ValueError):
    pass


def is_safe(path: str) -> bool:
    """Relative and normal: no empty, `.` or `..` segment, no backslash."""
    return bool(path) and not path.startswith("/") and "\\" not in path and all(s not in ("", ".", "..") for s in path.split("/"))


def resolve_safe(root: str | Path, path: str) -> Path:
    """The path below root, with no symbolic link on the way and nothing outside."""
    if not is_safe(path):
        raise UnsafePath(path)
    base = Path(root).resolve()
    at = base
    for segment in path.split("/"):
        at = at / segment
        if at.is_symlink():
            raise UnsafePath(f"{path}: symbolic link")
    if at.exists() and not at.resolve().is_relative_to(base):
        raise UnsafePath(path)
    return at


def open_plain(path: Path) -> int:
    """A descriptor of a file that is not a symbolic link."""
    return os.open(path, os.O_RDONLY | getattr(os, "O_NOFOLLOW", 0))


def is_within(root: str | Path, path: str | Path) -> bool:
    return Path(path).resolve().is_relative_to(Path(root).resolve())
