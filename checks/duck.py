"""SQL for DuckDB put together from named steps."""

from __future__ import annotations

from muster.sources.sample import BASE_TABLES, Dialect, entity_sql, needed

DUCKDB = Dialect(
    days_since_1995="date_diff('day', DATE '1995-01-01', CAST({0} AS DATE))",
    plus_minutes="({0} + to_minutes(CAST({1} AS BIGINT)))",
    divided="({0} // {1})",
    ntz="TIMESTAMP",
)

GIVEN = BASE_TABLES


def assemble(steps: dict[str, str], body: str) -> str:
    """``body`` after the common table expressions it needs."""
    known = {**entity_sql(DUCKDB), **steps}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in needed(sql):
            if name in GIVEN or name in ordered:
                continue
            visit(known[name])
            ordered.append(name)

    visit(body)
    names = {name: name for name in (*GIVEN, *ordered)}
    ctes = ",\n".join(f"{name} AS ({known[name].format(**names)})" for name in ordered)
    return (f"WITH {ctes}\n" if ctes else "") + body.format(**names)
