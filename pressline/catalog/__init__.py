"""All registered queries; importing this package fills the registry."""

import importlib

from pressline.catalog.registry import ORACLES, QUERIES, SURVEY  # noqa: F401

MODULES: list[str] = ["analytics", "content", "state", "publishing", "reports", "streams", "canonical"]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"pressline.catalog.{name}")


load()
