"""Logs of dataset runs: on the console, coloured where it is a terminal, and in the dataset's own file."""

from __future__ import annotations

import logging
import os
import sys

_COLOURS = {logging.DEBUG: "36", logging.INFO: "32", logging.WARNING: "33", logging.ERROR: "31", logging.CRITICAL: "35"}
_FORMAT = "%(asctime)s %(levelname)s %(message)s"


class _Coloured(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return f"\x1b[{_COLOURS.get(record.levelno, '0')}m{super().format(record)}\x1b[0m"


def dataset_logger(root: str, dataset_id: str, verbose: bool = False) -> logging.Logger:
    """The logger of a dataset. It also writes to logs/<dataset_id>.log under root, where root is a folder of this machine."""
    log = logging.getLogger(f"helixframe.{root}.{dataset_id}")
    log.setLevel(logging.DEBUG if verbose else logging.INFO)
    log.propagate = False
    if not log.handlers:
        console = logging.StreamHandler()
        console.setFormatter((_Coloured if sys.stderr.isatty() else logging.Formatter)(_FORMAT))
        log.addHandler(console)
        local = root.removeprefix("file://")
        if "://" not in local:
            os.makedirs(f"{local}/logs", exist_ok=True)
            file = logging.FileHandler(f"{local}/logs/{dataset_id}.log")
            file.setFormatter(logging.Formatter(_FORMAT))
            log.addHandler(file)
    return log
