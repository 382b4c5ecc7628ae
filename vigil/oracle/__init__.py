"""SQL texts that state the expected result of each registered query."""

from __future__ import annotations

import re
from pathlib import Path

from vigil.sources.adapters import STATEMENTS, common_table_expressions

_FOLDER = Path(__file__).parent


def _shared() -> dict[str, str]:
    """Shared part by each table it defines."""
    parts = {}
    for path in sorted(_FOLDER.glob("*.cte")):
        text = path.read_text().strip()
        parts |= dict.fromkeys(re.findall(r"^(?:, |\), )(\w+) as \($", text, re.M), text)
    return parts


def statement(name: str) -> str:
    """Full text for one query: adapted tables, shared parts it names, and the query."""
    body = (_FOLDER / f"{name}.sql").read_text().strip()
    shared: set[str] = set()
    while True:  # parts may name tables of parts that come before them
        named = "\n".join([*sorted(shared), body])
        more = {
            text
            for table, text in _shared().items()
            if re.search(rf"(\bfrom|\bjoin|,) {table}\b", named) and not re.search(rf"^(, |\), ){table} as \($", named, re.M)
        }
        if not more:
            break
        shared |= more
    body = named
    used = [table for table in STATEMENTS if re.search(rf"\b{table}\b", body)]
    tables = common_table_expressions(used) if used else "with nothing as (select 1)"
    return f"{tables}\n{body}"


def statements() -> dict[str, str]:
    return {path.stem: statement(path.stem) for path in sorted(_FOLDER.glob("*.sql"))}
