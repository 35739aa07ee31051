"""Small SQL spellings shared by the oracle queries (DuckDB)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def norm(x: str) -> str:
    return f"lower(rtrim({x}))"


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def eq(x: str, label: str) -> str:
    return f"{norm(x)} = {lit(label.lower())}"


def isin(x: str, labels: Iterable[str]) -> str:
    return f"{norm(x)} IN ({', '.join(lit(v.lower()) for v in labels)})"


def like(x: str, pattern: str) -> str:
    return f"lower({x}) LIKE {lit(pattern.lower())}"


def pick(rules: Sequence[tuple[str, str]], other: str = "NULL") -> str:
    """The value of the first rule whose condition holds."""
    return "CASE " + "\n            ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f"\n            ELSE {other} END"


def spelled(x: str, labels: Iterable[str]) -> str:
    """``x`` in the spelling of its label, else without trailing blanks."""
    return pick([(eq(x, v), lit(v)) for v in labels], f"rtrim({x})")


def columns(names: Iterable[str], of: str = "") -> str:
    return ", ".join(f"{of}.{n}" if of else n for n in names)


# Key columns that are not text; text keys compare without case and trailing blanks.
NOT_TEXT = {
    "FiscalYear", "NBB", "SignatureDate", "Renewal_Package_FirstSigned", "Renewal_Campaign_FirstSigned", "Upcoming_Tenure_Index",
    "first_signed", "enr_now", "enr_next", "signed_before", "signed_now", "oth_now", "oth_next",
}


def key(name: str, of: str = "") -> str:
    x = f"{of}.{name}" if of else name
    return x if name in NOT_TEXT else norm(x)


def same(a: str, b: str, names: Iterable[str]) -> str:
    return " AND ".join(f"{key(n, a)} = {key(n, b)}" for n in names)


def keys(names: Iterable[str], of: str = "") -> str:
    """For GROUP BY."""
    return ", ".join(key(n, of) for n in names)


def shown(names: Iterable[str], of: str = "") -> str:
    """The grouped columns, text in its least spelling."""
    return ", ".join(f"{of}.{n}" if of and n in NOT_TEXT else n if n in NOT_TEXT else f"min({of + '.' if of else ''}{n}) AS {n}" for n in names)


def ctes(stages: Sequence[tuple[str, str]], upto: str) -> str:
    """The stages as CTE definitions, up to and including ``upto``."""
    out = []
    for name, body in stages:
        out.append(f"{name} AS (\n{body}\n)")
        if name == upto:
            break
    return ",\n".join(out)
