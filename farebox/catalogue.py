"""Imports every module that registers queries."""

import importlib
import pkgutil

from farebox import functions, operators, plans, sources, streaming

for package in (plans, operators, functions, sources, streaming):
    for module in pkgutil.iter_modules(package.__path__, package.__name__ + "."):
        importlib.import_module(module.name)
