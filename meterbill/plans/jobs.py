"""End-to-end jobs composed from the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from meterbill.operators.analytics import region_revenue
from meterbill.operators.billing import documents_of, invoice_terms, invoices_of
from meterbill.operators.mediation import mediate
from meterbill.operators.rating import rate
from meterbill.schemas import DEFAULT_BILLING, DEFAULT_TARIFF, BillingRules, TariffRules
from meterbill.sources.cdr import decode_cdr
from meterbill.sources.sinks import write_invoice_documents, write_rated


def run_mediation(raw: DataFrame) -> DataFrame:
    """Messages (``value``) -> normalized_cdr. Works on batch and streaming
    frames alike; the dedup step follows ``raw.isStreaming``."""
    return mediate(decode_cdr(raw))


def run_rating(normalized: DataFrame, customers: DataFrame, rates: DataFrame, rated: DataFrame,
               as_of: dt.date, rules: TariffRules = DEFAULT_TARIFF,
               arrived_since: dt.date | None = None) -> DataFrame:
    """New rated_cdr rows (append them with ``sinks.write_rated``).
    ``arrived_since`` bounds an incremental run (see ``operators.rating.unprocessed``)."""
    return rate(normalized, customers, rates, rated, as_of, rules, arrived_since)


def run_billing(customers: DataFrame, rates: DataFrame, rated: DataFrame, invoices: DataFrame,
                as_of: dt.date, rules: BillingRules = DEFAULT_BILLING,
                stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(new invoice rows, invoice documents) for the month of ``as_of``. With
    ``stage_path`` the terms are computed once, written there, and both
    results read them; without it each result computes its own."""
    terms = invoice_terms(customers, rates, rated, invoices, as_of, rules)
    if stage_path is not None:
        terms.write.mode("overwrite").parquet(stage_path)
        terms = terms.sparkSession.read.schema(terms.schema).parquet(stage_path)
    return invoices_of(terms), documents_of(terms, rules)


def run_pipeline(raw: DataFrame, customers: DataFrame, rates: DataFrame, rated: DataFrame,
                 invoices: DataFrame, as_of: dt.date, months: int = 12,
                 stage_path: str | None = None, documents_path: str | None = None) -> DataFrame:
    """Mediation -> rating -> billing -> revenue by region.

    With ``stage_path`` (a folder in the shared checkpoint location) the newly
    rated rows and the invoice terms are written there and read back. That
    cuts the lineage: a lost executor during billing re-reads the written
    rows instead of re-running mediation and rating from the raw messages.
    With ``documents_path`` the invoice documents are added there.
    """
    normalized = run_mediation(raw)
    new_rated = run_rating(normalized, customers, rates, rated, as_of)
    if stage_path is not None:
        write_rated(new_rated, f"{stage_path}/rated", mode="overwrite")
        new_rated = new_rated.sparkSession.read.parquet(f"{stage_path}/rated")
    all_rated = rated.unionByName(new_rated, allowMissingColumns=True)
    new_invoices, documents = run_billing(customers, rates, all_rated, invoices, as_of,
                                          stage_path=stage_path and f"{stage_path}/terms")
    if documents_path is not None:
        write_invoice_documents(documents, documents_path, [as_of.strftime("%Y-%m")])
    return region_revenue(invoices.unionByName(new_invoices), customers, as_of, months)
