"""Derived features. Each set is one projection over its input; nothing here shuffles,
except the exact median behind the high-value flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.buckets import BUCKETS
from stayrate.functions.columns import add_up, as_col, flag, has_any, is_yes, recode, to_number
from stayrate.operators.encoding import medians
from stayrate.schema import PREMIUM, SERVICES, STREAMING

# Risk maps.
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}
PAYMENT_RISK = {
    "Electronic check": 3,
    "Mailed check": 2,
    "Bank transfer (automatic)": 1,
    "Credit card (automatic)": 1,
}
ACTIVE = ["Yes", "DSL", "Fiber optic"]


def tenure_features() -> dict[str, Column]:
    tenure = F.col("tenure")
    return {
        "tenure_bucket": BUCKETS["fe"].expr(),
        "tenure_years": tenure / F.lit(12.0),
        "is_new_customer": flag(tenure <= 6),
        "is_loyal_customer": flag(tenure > 48),
    }


def charge_per_month() -> Column:
    """Total over tenure + 1, defined for new customers too."""
    return F.col("TotalCharges") / (F.col("tenure") + 1)


def charge_per_tenure() -> Column:
    """Total over tenure; a customer without a full month counts the monthly charge."""
    return F.when(
        F.col("tenure") > 0, F.try_divide(F.col("TotalCharges"), F.col("tenure"))
    ).otherwise(F.col("MonthlyCharges"))


def charge_difference() -> Column:
    return F.col("TotalCharges") - F.col("MonthlyCharges") * F.col("tenure")


def above_median(df: DataFrame, column: str = "MonthlyCharges") -> Column:
    """1 above the exact median of ``df``."""
    return flag(F.col(column) > F.lit(medians(df, [column]).get(column)))


def high_value(limit: float = 70) -> Column:
    return F.when(F.col("MonthlyCharges") > limit, "Yes").otherwise("No")


def financial_features(df: DataFrame) -> dict[str, Column]:
    return {
        "charges_bucket": BUCKETS["chg_fe"].expr(),
        "avg_charges_per_tenure": charge_per_month(),
        "charges_difference": charge_difference(),
        "is_high_value": above_median(df),
    }


def service_flags(columns: list[str] | None = None) -> dict[str, Column]:
    return {f"{c}_flag": flag(F.col(c).isin(ACTIVE)) for c in (columns or SERVICES)}


def service_count(columns: list[str] | None = None) -> Column:
    return add_up(list(service_flags(columns).values()))


def adoption_score() -> Column:
    """Subscribed services; any internet service counts, whichever kind it is."""
    return add_up(
        [flag(F.col(c) != "No") if c == "InternetService" else is_yes(c) for c in SERVICES]
    )


def service_features() -> dict[str, Column]:
    return {
        "total_services": service_count(),
        "has_internet": flag(F.col("InternetService") != "No"),
        "has_phone": is_yes("PhoneService"),
        "has_premium_services": has_any(PREMIUM),
        "has_streaming": has_any(STREAMING),
    }


def auto_payment() -> Column:
    return flag(F.lower("PaymentMethod").contains("automatic"))


def payment_reliability() -> Column:
    return F.when(F.col("PaymentMethod").like("%automatic%"), "High").otherwise("Low")


def contract_features() -> dict[str, Column]:
    return {
        "contract_risk_score": recode("Contract", CONTRACT_RISK),
        "is_month_to_month": flag(F.col("Contract") == "Month-to-month"),
        "payment_risk_score": recode("PaymentMethod", PAYMENT_RISK),
        "is_auto_payment": auto_payment(),
    }


def demographic_features() -> dict[str, Column]:
    return {
        "has_family": has_any(["Partner", "Dependents"]),
        "is_single_senior": flag(
            (F.col("SeniorCitizen") == 1) & (F.col("Partner") == "No") & (F.col("Dependents") == "No")
        ),
    }


def all_features(df: DataFrame) -> DataFrame:
    """Every feature group in one projection."""
    return df.withColumns(
        {
            **tenure_features(),
            **financial_features(df),
            **service_features(),
            **contract_features(),
            **demographic_features(),
        }
    )


def batch_features(df: DataFrame) -> DataFrame:
    """The shorter feature set of the batch data step."""
    return df.withColumns(
        {
            "tenure_bucket": BUCKETS["dp"].expr(),
            "charges_bucket": BUCKETS["chg_dp"].expr(),
            "service_count": service_count(),
            "avg_charges_per_month": charge_per_month(),
            "high_value": above_median(df),
            "contract_risk": recode("Contract", CONTRACT_RISK),
        }
    )


def spark_features(df: DataFrame) -> DataFrame:
    """Buckets, guarded average, value flag, nine service flags and their count."""
    return df.withColumns(
        {
            "tenure_bucket": BUCKETS["spark4"].expr(),
            "avg_charges_per_tenure": charge_per_tenure(),
            "high_value_customer": high_value(),
            **service_flags(),
            "service_count": service_count(),
        }
    )


def adoption_recode(df: DataFrame) -> DataFrame:
    """Recode the service columns to 0/1 in place, then score and average charges over them."""
    recoded = [c for c in SERVICES if c != "InternetService"]
    counted = ["HasInternetService" if c == "InternetService" else c for c in SERVICES]
    ones = df.withColumns(
        {"HasInternetService": flag(F.col("InternetService") != "No"), **{c: is_yes(c) for c in recoded}}
    )
    scored = ones.withColumn("ServiceAdoptionScore", add_up([F.col(c) for c in counted]))
    return scored.withColumns(
        {
            "AvgMonthlyChargesPerService": charge_per_service("ServiceAdoptionScore"),
            "PaymentReliability": F.when(auto_payment() == 1, "High").otherwise("Low"),
        }
    )


def charge_per_service(score: Column | str) -> Column:
    value = as_col(score)
    return F.when(value > 0, F.try_divide(F.col("MonthlyCharges"), value)).otherwise(F.lit(0.0))


def transformed_table(df: DataFrame) -> DataFrame:
    """Column list of the transformed customer table."""
    return df.select(
        "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
        BUCKETS["sql3"].expr().alias("tenure_category"),
        *SERVICES,
        "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges",
        to_number("TotalCharges").cast("decimal(10,2)").alias("TotalCharges"),
        adoption_score().alias("service_adoption_score"),
        payment_reliability().alias("payment_reliability"),
        "Churn",
        is_yes("Churn").alias("churn_flag"),
    )
