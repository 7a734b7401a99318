"""Logging of the runner: everything to a file, what a user follows to the terminal."""

from __future__ import annotations

import logging

_FORM = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")


def get_logger(name: str = "sheafwork", path: str | None = None) -> logging.Logger:
    """A logger that shows INFO and above, and writes DEBUG and above to ``path`` if one is given; asking again adds nothing."""
    logger = logging.getLogger(name)
    logger.setLevel(logging.DEBUG)
    logger.propagate = False
    known = {getattr(h, "baseFilename", "terminal") for h in logger.handlers}
    if "terminal" not in known:
        shown = logging.StreamHandler()
        shown.setLevel(logging.INFO)
        shown.setFormatter(_FORM)
        logger.addHandler(shown)
    if path is not None:
        kept = logging.FileHandler(path, encoding="utf-8", delay=True)
        kept.setLevel(logging.DEBUG)
        kept.setFormatter(_FORM)
        if kept.baseFilename not in known:
            logger.addHandler(kept)
    return logger
