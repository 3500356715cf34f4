"""Tables that SQL statements read: tokens, and one walk over them that knows FROM lists, subqueries and the scope of common tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_PART = r'(?:[A-Za-z_][A-Za-z0-9_$]*|"(?:[^"]|"")*"|`(?:[^`]|``)*`)'
TOKEN = re.compile(rf"(?P<skip>--[^\n]*|/\*.*?(?:\*/|\Z)|'(?:[^']|'')*(?:'|\Z))|(?P<name>{_PART}(?:\s*\.\s*{_PART})*)|(?P<sign>[(),;])|(?P<other>[^\s(),;'\"`A-Za-z_]+|.)", re.S)
PART = re.compile(_PART)
#: Keywords after which a FROM list is over.
ENDS = frozenset("SELECT WHERE GROUP ORDER HAVING LIMIT UNION INTERSECT EXCEPT MINUS QUALIFY WINDOW SET VALUES RETURNING OFFSET FETCH WHEN".split())
#: Words between a FROM or JOIN and the table that they announce.
FILLERS = frozenset(("LATERAL", "ONLY", "TABLE"))
#: Functions with a FROM of their own.
OWN_FROM = frozenset(("EXTRACT", "SUBSTRING", "TRIM", "OVERLAY", "POSITION"))


def _plain(name: str) -> str:
    """A dotted name without quotes, upper case."""
    return ".".join(p[1:-1].replace(p[0] * 2, p[0]) if p[0] in '"`' else p for p in PART.findall(name)).upper()


def tables_read(sql: str) -> set[str]:
    """Names after FROM, JOIN and the commas of a FROM list; not in comments and strings, no functions, and no common table where it is in scope."""
    tokens = [(m.lastgroup, m.group()) for m in TOKEN.finditer(sql) if m.lastgroup != "skip" and not m.group().isspace()] + [("end", "")]
    found: set[str] = set()
    levels = [{"list": False, "with": False, "function": False}]  # one for each open bracket
    visible: list[tuple[str, int]] = []  # common tables and the depth at which they were declared
    pending: dict[int, str] = {}  # a common table that is not closed yet
    before_body: dict[int, bool] = {}  # whether its AS has come: what closes next is its body, not its list of columns
    recursive = expecting = False
    before = ""
    for i, (kind, text) in enumerate(tokens[:-1]):
        word, top = text.upper(), levels[-1]
        if text == "(":
            levels.append({"list": expecting, "with": False, "function": before in OWN_FROM})  # after FROM: a subquery or a join in brackets
        elif text == ")":
            if len(levels) > 1:
                levels.pop()
            depth = len(levels)
            visible = [v for v in visible if v[1] <= depth]
            if depth in pending and before_body.get(depth):
                visible.append((pending.pop(depth), depth))
        elif text == ",":
            expecting = top["list"]
        elif text == ";":
            levels, visible, pending, expecting = [{"list": False, "with": False, "function": False}], [], {}, False
        elif kind == "name":
            if word == "WITH" and tokens[i + 1][0] == "name":
                top["with"], recursive = True, False
            elif word == "RECURSIVE" and before == "WITH":
                recursive = True
            elif word == "AS" and len(levels) in pending:
                before_body[len(levels)] = True
                if recursive:
                    visible.append((pending[len(levels)], len(levels)))
            elif top["with"] and before in ("WITH", "RECURSIVE", ",") and not top["list"]:
                pending[len(levels)] = _plain(text)
                before_body[len(levels)] = False
            elif word == "FROM":
                if not top["function"] and before != "DISTINCT":
                    top["list"] = expecting = True
            elif word == "JOIN":
                top["list"] = expecting = True
            elif word in ENDS:
                top["list"] = expecting = False
                top["with"] = top["with"] and word != "SELECT"
            elif expecting and word not in FILLERS:
                name = _plain(text)
                if tokens[i + 1][1] != "(" and not any(name == v for v, _ in visible):
                    found.add(name)
                expecting = False
        else:
            expecting = False
        before = word
    return found


def extract_refs(log: DataFrame, sql_col: str, key: str) -> DataFrame:
    """(key, table_name): tables that statements read, upper case, once per statement. Quoted names lose their quotes; null statements read nothing.

    Batch by batch, without a shuffle but for repeated keys; a statement is read once from left to right.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            refs = [sorted(tables_read(s)) if s else [] for s in b.column(1).to_pylist()]
            at = [i for i, r in enumerate(refs) for _ in r]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([t for r in refs for t in r], pa.string())], names=[key, "table_name"])

    kind = log.schema[key].dataType.simpleString()
    return log.select(key, sql_col).mapInArrow(run, f"`{key}` {kind}, table_name string").distinct()
