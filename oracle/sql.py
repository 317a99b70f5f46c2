"""Helpers that compose oracle statements from named common table expressions."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _needs(body: str) -> list[str]:
    words = set(re.findall(r"[a-z_][a-z0-9_]*", body))
    return [name for name in CTES if name in words]


def statement(body: str) -> str:
    """``body`` preceded by the expressions it refers to, directly or not."""
    wanted: set[str] = set()
    todo = _needs(body)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(CTES[name]) if n != name]
    parts = [f"{name} AS (\n{text}\n)" for name, text in CTES.items() if name in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


# --- expression helpers -----------------------------------------------------------
def gid(kind: str, number: str) -> str:
    return f"('gid://store/{kind}/' || CAST({number} AS VARCHAR))"


def pad(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS VARCHAR), {width}, '0')"


def cycle(number: str, labels: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels) if label is not None)
    return f"(CASE ({number}) % {len(labels)} {arms} END)"


def cents(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def digits(value: str) -> str:
    return f"NULLIF(regexp_extract({value}, '[0-9]+$'), '')"


def units(value: str) -> str:
    """A two-decimal amount as an exact whole number of cents."""
    return f"CAST(({value}) * 100 AS HUGEINT)"


def half_up(numerator: str, denominator: str, places: int = 2) -> str:
    """numerator / denominator (whole numbers, denominator positive) rounded half up."""
    scale = 10**places
    return (
        f"(CAST(sign({numerator}) AS HUGEINT) * ((abs({numerator}) * {2 * scale} + ({denominator})) "
        f"// (2 * ({denominator}))) / {scale}.0)"
    )


def after(ts: str, days: str = "0", seconds: str = "0") -> str:
    return f"({ts} + to_days(CAST({days} AS INTEGER)) + to_seconds({seconds}))"


def date_key(value: str) -> str:
    return f"CAST(strftime({value}, '%Y%m%d') AS INTEGER)"


def rate(numerator: str, denominator: str, scale: str = "") -> str:
    """Reported ratio in doubles; NULL on a zero denominator."""
    times = f" * CAST({scale} AS DOUBLE)" if scale else ""
    return f"(CAST({numerator} AS DOUBLE){times} / NULLIF(CAST({denominator} AS DOUBLE), 0))"


# --- result contract ----------------------------------------------------------------
_KINDS = {
    "i": "CAST({0} AS BIGINT)",
    "m": "CAST(CAST({0} AS DECIMAL(28,2)) AS DOUBLE)",
    "r": "CAST({0} AS DOUBLE)",
    "s": "CAST({0} AS VARCHAR)",
    "d": "CAST(CAST({0} AS DATE) AS VARCHAR)",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "b": "CAST({0} AS BOOLEAN)",
}


def present(body: str, contract: list[tuple[str, str]]) -> str:
    """Wrap a result so that both engines show the same names and plain types."""
    shown = ", ".join(f"{_KINDS[kind].format(name)} AS {name}" for name, kind in contract)
    return f"SELECT {shown} FROM (\n{body.strip()}\n) AS result"
