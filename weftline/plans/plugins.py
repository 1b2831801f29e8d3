"""Builds from configuration: steps, adapters and converters named by import path, loaded when the build is made."""

from __future__ import annotations

import functools
import importlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from weftline.plans.pipeline import Step


def named(path: str) -> Callable:
    """The function at ``package.module:name``."""
    module, _, name = path.partition(":")
    if not name:
        raise ValueError(f"{path} is not of the form package.module:name")
    return functools.reduce(getattr, name.split("."), importlib.import_module(module))


def parsed(text: str) -> dict:
    """Configuration as JSON, or as YAML where its library is installed."""
    try:
        return json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("the configuration is no JSON, and YAML cannot be read here") from e
        return yaml.safe_load(text)


def steps(config: dict) -> list[Step]:
    """The steps of ``{"steps": [{"name", "make", "needs", "params"}]}``, in the order of their needs; a circle raises."""
    made = {c["name"]: Step(c["name"], named(c["make"]), tuple(c.get("needs", ())), dict(c.get("params", {}))) for c in config["steps"]}
    out: list[Step] = []
    waiting = dict(made)
    while waiting:
        ready = [n for n, s in waiting.items() if all(x not in waiting for x in s.needs)]
        if not ready:
            raise ValueError(f"steps need each other: {sorted(waiting)}")
        out += [waiting.pop(n) for n in ready]
    if lost := {n for s in out for n in s.needs} - made.keys():
        raise ValueError(f"steps need what is not there: {sorted(lost)}")
    return out


def convert(tables: dict[str, DataFrame], converters: dict[str, Iterable[Callable[[DataFrame], tuple[str, DataFrame]]]]) -> dict[str, DataFrame]:
    """Target tables of source tables: each converter of a source gives (target, rows); rows for one target are put together."""
    out: dict[str, DataFrame] = {}
    for source, df in tables.items():
        for make in converters.get(source, ()):
            target, rows = make(df)
            out[target] = out[target].unionByName(rows, allowMissingColumns=True) if target in out else rows
    return out
