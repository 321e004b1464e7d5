"""Money as exact decimals: sums do not depend on shuffle order; doubles only leave at the end."""

from pyspark.sql import Column, functions as F

# The closed set of line types, split by whether they count as revenue.
REVENUE_LINE_TYPES = ("SALE", "RETURN", "DISCOUNT", "VOID")


def is_revenue(line_type: Column) -> Column:
    return line_type.isin(*REVENUE_LINE_TYPES)


def money(amount: Column) -> Column:
    return amount.cast("decimal(18,2)")


def line_amount(qty: Column, unit_price: Column) -> Column:
    """Quantity times price to the cent; the sign of either carries returns, voids and discounts."""
    return money(F.round(qty.cast("decimal(18,3)") * unit_price.cast("decimal(18,4)"), 2))


def total(amount: Column) -> Column:
    """Exact sum, shown as a double with two decimals."""
    return F.sum(amount).cast("decimal(38,2)").cast("double")
