"""DuckDB statements that answer the registered queries independently."""

from oracles import commerce, market, retail


def all_statements() -> dict[str, str]:
    return {**retail.statements(), **commerce.statements(), **market.statements()}
