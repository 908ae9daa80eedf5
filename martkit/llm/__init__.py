"""Operators for large training corpora; nothing else in the library imports them."""

from __future__ import annotations

import importlib
import pkgutil

from pyspark import cloudpickle

# Functions sent to workers carry their code with them: executors need not have the library installed.
for _module in pkgutil.iter_modules(__path__):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_module.name}"))
