"""End-to-end plans: what a producer does, what a consumer does, and the closing summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from weir.functions.money import DECIMAL, MoneyPolicy, quantity
from weir.functions.rules import Rule, computable
from weir.operators import aggregate
from weir.operators.contract import ERROR_TEXT, Contract
from weir.operators.lookup import Lookup
from weir.operators.project import project
from weir.operators.validate import check, invalid_rows, valid_rows, validate, with_error_text
from weir.sources.topics import encode

Enricher = Callable[[DataFrame, Lookup, MoneyPolicy], DataFrame]


def produce(records: DataFrame, contract: Contract, references: Mapping[str, Lookup]) -> tuple[DataFrame, DataFrame]:
    """Validate records fully; return the messages to publish and the rejected records."""
    checked = validate(records, contract, references)
    rejected = with_error_text(invalid_rows(checked))
    return encode(valid_rows(checked), contract), project(rejected, [*contract.required, ERROR_TEXT])


def computable_rules(policy: MoneyPolicy) -> tuple[Rule, Rule]:
    """The numbers an enrichment needs. A row without them is quarantined, never a failed job."""
    return computable("quantity", quantity), computable("unit_price", policy.price)


def consume(
    messages: DataFrame, contract: Contract, rates: Lookup, enricher: Enricher, policy: MoneyPolicy = DECIMAL
) -> DataFrame:
    """Check the required fields again and add the derived fields; both branches in one frame."""
    checked = check(messages, contract.required, computable_rules(policy))
    return enricher(checked, rates, policy)


def with_computable(contract: Contract, policy: MoneyPolicy = DECIMAL) -> Contract:
    """The contract with the consumer's rules: one check that stands for a producer's and a consumer's after it."""
    return replace(contract, rules=(*contract.rules, *computable_rules(policy)))


def ask(spark: SparkSession, question: str, **named: DataFrame) -> DataFrame:
    """Answer a question in SQL over tables named in braces, such as ``SELECT * FROM {accepted}``.

    The tables are plans, not copies, so the whole question is one plan.
    """
    return spark.sql(question, **named)


def storage_summary(accepted: DataFrame, rejected: DataFrame, contract: Contract) -> dict[str, DataFrame]:
    """Return the closing report over the landed tables: one small frame per question."""
    report = {
        "accepted": aggregate.row_count(accepted, "accepted_count"),
        "rejected": aggregate.row_count(rejected, "rejected_count"),
    }
    if contract.key == "region_id":
        report["by_region"] = aggregate.count_by(accepted, "region_id", "sale_count")
    else:
        report["by_store"] = aggregate.revenue_by(accepted, "store_id")
        report["by_size"] = aggregate.revenue_by(accepted, "size")
        report["by_loyalty"] = aggregate.by_loyalty(accepted)
    return report
