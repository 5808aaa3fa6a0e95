"""No module says a thing twice: of two definitions of one name the later silently wins."""

from __future__ import annotations

import ast
from collections import Counter
from pathlib import Path

import pytest

from fiscora.llm import common

MODULES = sorted(Path(common.__file__).parent.glob("*.py"))


@pytest.mark.parametrize("module", MODULES, ids=lambda p: p.stem)
def test_names_are_defined_once(module):
    kinds = (ast.FunctionDef, ast.ClassDef)
    for scope in ast.walk(ast.parse(module.read_text())):
        names = Counter(x.name for x in getattr(scope, "body", []) if isinstance(x, kinds)) if isinstance(scope, (ast.Module, *kinds)) else {}
        assert [n for n, c in names.items() if c > 1] == []
