"""The registry's claims: a query that says it covers an operator calls a function of it."""

import importlib.util
import re
import sys
from pathlib import Path

import pytest

from sparkmart.plans import registry
from tests.conftest import SF001

ROOT = Path(__file__).resolve().parent.parent
_spec = importlib.util.spec_from_file_location("coverage_table", ROOT / "scripts" / "coverage.py")
coverage_table = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(coverage_table)


def _functions(where: str) -> set[tuple[str, str]]:
    """(module, function) pairs named in a row of the coverage table."""
    found, module = set(), None
    for word in re.findall(r"[A-Za-z_]+(?:/[a-z_]+)?(?:\.[A-Za-z_]+)*", re.sub(r"\([^)]*\)", "", where)):
        path, _, name = word.rpartition(".")
        if "/" in word or (path and (ROOT / "sparkmart" / f"{path}.py").exists()):
            module, word = (path, name) if path else (word, "")
        if module and word and (ROOT / "sparkmart" / f"{module}.py").exists():
            found.add((module, word.rpartition(".")[2]))
    return found


# Queries of model fits run for minutes; the others build their plans here.
NAMES = [n for n in registry.queries() if n in registry.oracle_sql()]


@pytest.mark.parametrize("name", NAMES)
def test_claimed_operators_are_called(spark, name):
    called = set()

    def seen(frame, event, _arg):
        if event == "call" and "/sparkmart/" in frame.f_code.co_filename:
            path = frame.f_code.co_filename.rpartition("/sparkmart/")[2].removesuffix(".py")
            called.add((path, frame.f_code.co_name))
    sys.setprofile(seen)
    try:
        registry.queries()[name](spark, SF001)
    finally:
        sys.setprofile(None)
    for claim in registry.coverage()[name]:
        functions = _functions(coverage_table.WHERE.get(claim, ""))
        functions = {f for f in functions if f[1] in (ROOT / "sparkmart" / f"{f[0]}.py").read_text()}
        assert not functions or functions & called, (claim, functions)
