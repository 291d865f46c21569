"""Small display expressions for dashboard rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label fragment -> colour, first fragment found wins, case matters.
CONTRACT_COLOURS = {
    "Full": "#2563eb",
    "Contract": "#f59e0b",
    "Part": "#10b981",
    "Intern": "#8b5cf6",
    "Temp": "#ef4444",
    "Volunteer": "#ec4899",
}
OTHER_COLOUR = "#64748b"
# Sentence formats shown to the reader.
SIZE_SENTENCE = "👉 Most opportunities come from company size: %s"
INDUSTRY_SENTENCE = "🌍 Industrie dominante : **%s**  \n📊 Volume : **%s offres**"


def whole_percent(share: Column) -> Column:
    """Share of one as whole percent, fraction cut off (not rounded)."""
    return (share.cast("double") * F.lit(100.0)).cast("int")


def grouped_digits(n: Column) -> Column:
    """12345 -> '12,345'."""
    return F.format_number(n, 0)


def contract_colour(label: Column) -> Column:
    """Colour of the first known fragment inside ``label``."""
    chain = F
    for fragment, colour in CONTRACT_COLOURS.items():
        chain = chain.when(label.contains(fragment), F.lit(colour))
    return chain.otherwise(F.lit(OTHER_COLOUR))


def size_sentence(size: Column) -> Column:
    return F.format_string(SIZE_SENTENCE, size.cast("string"))


def industry_sentence(name: Column, n: Column) -> Column:
    return F.format_string(INDUSTRY_SENTENCE, name, grouped_digits(n))
