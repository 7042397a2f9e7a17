"""Column expressions that grade or classify scores, configurations and origins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Agreement bands and their upper borders.
KAPPA_BANDS = [
    (0.0, "poor (< 0)"),
    (0.20, "slight (0.00–0.20)"),
    (0.40, "fair (0.20–0.40)"),
    (0.60, "moderate (0.40–0.60)"),
    (0.80, "substantial (0.60–0.80)"),
]
KAPPA_TOP = "almost perfect (0.80–1.00)"

# Accuracy buckets, closed at the upper border.
ACCURACY_BUCKETS = [
    (50.0, "<50%"),
    (70.0, "50–70%"),
    (85.0, "70–85%"),
    (95.0, "85–95%"),
    (100.0, "95–100%"),
]

# What decided a column type.
MODEL_TYPES = {"categorical", "ordinal", "unknown", "llm_error"}

# Tokens per call as base + rate * inputs (in, out) and price per million (in, out).
CALL_COST = {
    "8b": ((2377, 24), (-15, 45), ("0.050", "0.080")),
    "20b": ((2415, 24), (255, 46), ("0.075", "0.300")),
    "120b": ((2415, 24), (161, 52), ("0.150", "0.600")),
    "235b": ((2383, 25), (760, 129), ("0.071", "0.100")),
}
# Tokens per call of any other model; its price is not known.
CALL_TOKENS_DEFAULT = ((2400, 24), (300, 60))


def kappa_band(kappa: Column) -> Column:
    out = F.when(kappa.isNull(), F.lit("n/a"))
    for border, name in KAPPA_BANDS:
        out = out.when(kappa < border, F.lit(name))
    return out.otherwise(F.lit(KAPPA_TOP))


def accuracy_bucket(accuracy: Column) -> Column:
    out = F.when(accuracy.isNull() | (accuracy < 0) | (accuracy > 100), F.lit(None).cast("string"))
    for border, name in ACCURACY_BUCKETS:
        out = out.when(accuracy <= border, F.lit(name))
    return out


def config_model(config: Column) -> Column:
    return F.regexp_extract(config, "^(.*)_([^_]+)$", 1)


def config_format(config: Column) -> Column:
    return F.regexp_extract(config, "^(.*)_([^_]+)$", 2)


def column_type_origin(col_type: Column) -> Column:
    return (
        F.when(F.coalesce(col_type, F.lit("")) == "", F.lit("-"))
        .when(col_type.isin(sorted(MODEL_TYPES)), F.lit("LLM"))
        .otherwise(F.lit("Rule"))
    )


def codebook_origin(parse_method: Column, source: Column) -> Column:
    return (
        F.when(parse_method == "haven", F.lit("haven-embedded"))
        .when(F.lower(source).contains("readme"), F.lit("README"))
        .otherwise(F.lit("structured file"))
    )


def call_cost(model: Column, inputs: Column) -> dict[str, Column]:
    """Tokens in, tokens out (never negative) and price of one call with ``inputs`` items.

    The price is in millionths, as an exact decimal. Other models have the default's tokens and a
    null price.
    """

    def tokens(fit: tuple[int, int]) -> Column:
        return F.greatest(F.lit(0), inputs * fit[1] + fit[0]).cast("bigint")

    tokens_in, tokens_out = map(tokens, CALL_TOKENS_DEFAULT)
    price = F.lit(None).cast("decimal(28,3)")
    for name, (fit_in, fit_out, prices) in CALL_COST.items():
        parts = [
            tokens(fit).cast("decimal(18,0)") * F.lit(p).cast("decimal(6,3)")
            for fit, p in zip((fit_in, fit_out), prices, strict=True)
        ]
        tokens_in = F.when(model == name, tokens(fit_in)).otherwise(tokens_in)
        tokens_out = F.when(model == name, tokens(fit_out)).otherwise(tokens_out)
        price = F.when(model == name, (parts[0] + parts[1]).cast("decimal(28,3)")).otherwise(price)
    return {"tokens_in": tokens_in, "tokens_out": tokens_out, "price": price}
