"""Metric questions over a fact, answered from a semantic model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.hexnum import total_hex

AGGREGATES = {
    "sum": F.try_sum,
    "avg": F.try_avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_if": F.count_if,
    # Exact at any size: hex digits of fixed width, which sort like the number.
    "sum_hex": total_hex,
}


@dataclass(frozen=True)
class SemanticModel:
    """Names a question may use, each with the expression behind it."""

    name: str
    dimensions: dict[str, str]
    facts: dict[str, str]
    time_dimensions: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_spec(cls, spec: dict) -> SemanticModel:
        """From a table entry of a semantic-model file: lists of name and expr."""

        def named(kind: str) -> dict[str, str]:
            entries = spec.get(kind, [])
            return {e["name"].lower(): str(e.get("expr", e["name"])).lower() for e in entries}

        return cls(
            name=spec["name"].lower(),
            dimensions=named("dimensions"),
            facts=named("facts"),
            time_dimensions=named("time_dimensions"),
        )

    def dimension(self, name: str) -> Column:
        known = {**self.dimensions, **self.time_dimensions}
        return F.expr(known[self._check(name, known)]).alias(name)

    def measure(self, aggregate: str, fact: str, alias: str) -> Column:
        if aggregate not in AGGREGATES:
            raise ValueError(f"unknown aggregate {aggregate!r}, use one of {list(AGGREGATES)}")
        expression = F.lit(1) if fact == "*" else F.expr(self.facts[self._check(fact, self.facts)])
        return AGGREGATES[aggregate](expression).alias(alias)

    def _check(self, name: str, known: dict[str, str]) -> str:
        if name not in known:
            raise ValueError(f"{self.name} has no {name!r}, only {sorted(known)}")
        return name


MINT_MODEL = SemanticModel(
    name="fct_mint",
    dimensions={
        name: name
        for name in (
            "contract_address", "date_key", "log_index", "minting_address", "transaction_hash"
        )
    },
    time_dimensions={"dbt_loaded_at": "dbt_loaded_at"},
    facts={
        "minted_amount": "minted_amount",
        "amount_hex": "amount_hex",
        "amount_overflow": "amount_overflow",
    },
)


def metric_query(
    df: DataFrame,
    model: SemanticModel,
    dimensions: list[str],
    measures: dict[str, tuple[str, str]],
    where: Column | str | None = None,
    order_by: list[str] | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Measures by dimensions: ``measures`` maps a name to (aggregate, fact).

    Ordered results also go by the dimensions, so that a limit is repeatable.
    Sums that leave the decimal range are NULL, not an error; ``sum_hex`` of the
    digits has no such range, so rank by it.
    """
    if where is not None:
        df = df.where(where)
    keys = [model.dimension(d) for d in dimensions]
    result = df.groupBy(*keys).agg(*[model.measure(*m, name) for name, m in measures.items()])
    if order_by:
        ranked = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
        result = result.orderBy(*ranked, *[F.col(d) for d in dimensions if d not in order_by])
    return result if limit is None else result.limit(limit)


def top_minters(fct_mint: DataFrame, n: int = 3) -> DataFrame:
    """The addresses that received the largest minted amounts.

    They are ranked by their exact totals, ``total_hex``. ``total_minted`` is NULL
    where the total leaves the decimal range, and does not hold the
    ``overflow_count`` mints whose own amount does.
    """
    return metric_query(
        fct_mint,
        MINT_MODEL,
        dimensions=["minting_address"],
        measures={
            "total_minted": ("sum", "minted_amount"),
            "total_hex": ("sum_hex", "amount_hex"),
            "mint_count": ("count", "*"),
            "overflow_count": ("count_if", "amount_overflow"),
        },
        order_by=["total_hex"],
        limit=n,
    )
