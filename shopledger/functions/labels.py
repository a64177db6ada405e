"""Status vocabularies and the rules that assign them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import col, or_zero

# The Russian wording readers of the original dashboards filter on.
RUSSIAN = {
    "fx_risk_status": {
        "HIGH": "Высокий валютный риск",
        "MODERATE": "Умеренный валютный риск",
        "EASING": "Снижение валютного давления",
        "STABLE": "Стабильный курс",
    },
    "management_status": {
        "LOST_SALES_RISK": "Риск упущенной выручки",
        "OVERSTOCK": "Избыточные запасы",
        "BELOW_PLAN": "Невыполнение плана",
        "NORMAL": "Норма",
    },
    "turnover_status": {
        "NO_SALES": "Нет продаж при наличии остатка",
        "NO_STOCK": "Продажи без остатка на конец месяца",
        "SHORTAGE_RISK": "Риск дефицита",
        "EXCESS_RISK": "Риск излишка",
        "NORMAL": "Норма",
    },
}


def in_russian(mart: DataFrame) -> DataFrame:
    """Swap status codes for the Russian wording in whichever columns exist."""
    for name, wording in RUSSIAN.items():
        if name in mart.columns:
            pairs = [F.lit(part) for item in wording.items() for part in item]
            mart = mart.withColumn(name, F.create_map(*pairs)[F.col(name)])
    return mart


def fx_risk(mom: Column | str) -> Column:
    mom = col(mom)
    return (
        F.when(mom >= 5, "HIGH").when(mom >= 2, "MODERATE").when(mom <= -2, "EASING")
        .otherwise("STABLE")
    )


def management(low: Column, over: Column, fact: Column, plan: Column) -> Column:
    """Lost sales outrank excess stock, which outranks a missed plan."""
    return (
        F.when((or_zero(low) > 0) & (or_zero(fact) > 0), "LOST_SALES_RISK")
        .when(or_zero(over) > 0, "OVERSTOCK")
        .when(or_zero(fact) < or_zero(plan), "BELOW_PLAN")
        .otherwise("NORMAL")
    )


def turnover(sold: Column, stock: Column, cover: Column) -> Column:
    sold, stock, cover = or_zero(sold), or_zero(stock), or_zero(cover)
    return (
        F.when((sold == 0) & (stock > 0), "NO_SALES")
        .when((stock == 0) & (sold > 0), "NO_STOCK")
        .when(cover < 7, "SHORTAGE_RISK")
        .when(cover > 45, "EXCESS_RISK")
        .otherwise("NORMAL")
    )


def plan_status(completion: Column | str) -> Column:
    """Null completion (no plan) has no status."""
    completion = col(completion)
    return (
        F.when(completion < 100, "NOT_MET").when(completion == 100, "MET")
        .when(completion > 100, "EXCEEDED")
    )


def abc(cumulative: Column | str) -> Column:
    cumulative = col(cumulative)
    return F.when(cumulative <= 80, "A").when(cumulative <= 95, "B").otherwise("C")
