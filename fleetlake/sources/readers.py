"""Entity readers (D1-D28): one per exposed dataset.

Each reader = a scan (export blobs or landed pages) + the dataset's contract
(C1), plus the record transform the dataset needs (antivirus health, A1).
The "pages" and "files" variants of a dataset return the same rows, so both
feed one reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform
from ..operators.flatten import flatten_av_health
from ..plans.contracts import contract
from ..functions.scalars import redact_url
from .export import CORRUPT, SOURCE, raw_lines, scan_export, scan_export_quarantine
from .pages import scan_pages


@dataclass(frozen=True)
class Dataset:
    contract: str
    key: tuple[str, ...]
    flatten: str | None = None  # "av" for antivirus-health export records


# Dataset -> contract and grain.
DATASETS: dict[str, Dataset] = {
    "machines": Dataset("machine", ("id",)),
    "alerts": Dataset("alert", ("id",)),
    "investigations": Dataset("investigation", ("id",)),
    "machine_actions": Dataset("machine_action", ("id",)),
    "indicators": Dataset("indicator", ("id",)),
    "software": Dataset("software", ("id",)),
    "vulnerabilities": Dataset("vulnerability", ("id",)),
    "machine_software_vulnerabilities": Dataset("public_asset_vulnerability_dto", ("id",)),
    "recommendations": Dataset("recommendation", ("id",)),
    "remediation_tasks": Dataset("remediation_task", ("id",)),
    "exposure_score": Dataset("configuration_score", ("time", "rbacGroupId")),
    "file_profiles": Dataset("file", ("sha1",)),
    "scan_definitions": Dataset("device_authenticated_scan_definition", ("id",)),
    "scan_agents": Dataset("device_authenticated_scan_agent", ("id",)),
    "scan_history": Dataset("auth_scan_history_contract", ("id",)),
    "library_files": Dataset("library_files", ("fileName",)),
    "browser_extension_permissions": Dataset("browser_extensions", ("key",)),
    "baseline_profiles": Dataset("baseline_profile", ("id",)),
    "baseline_configurations": Dataset("baseline_configuration", ("id",)),
    "browser_extension_inventory": Dataset("asset_browser_extension", ("deviceId", "extensionId")),
    "certificate_inventory": Dataset("asset_certificate_assessment", ("deviceId", "thumbprint")),
    "av_health": Dataset("device_av_info", ("machineId",), flatten="av"),
    "baseline_compliance": Dataset("asset_baseline_assessment", ("deviceId", "profileId", "configurationId")),
    "secure_configuration": Dataset("asset_configuration", ("deviceId", "configurationId")),
    "software_inventory": Dataset("asset_software", ("deviceId", "softwareVendor", "softwareName", "softwareVersion")),
    "software_inventory_non_cpe": Dataset("asset_non_cpe_software", ("deviceId", "softwareVendor", "softwareName", "softwareVersion")),
    "vulnerability_inventory": Dataset("asset_vulnerability", ("id",)),
    "vulnerability_changes": Dataset("delta_asset_vulnerability", ("id", "eventTimestamp")),
}

# Secret-bearing fields of scan definitions, nulled by default.
SCAN_SECRET_FIELDS = ("password", "privateKey", "authPassword", "privPassword", "communityString")


def read_export(spark: SparkSession, dataset: str, paths: list[str], *, mode: str = "FAILFAST",
                detect: str = "content", keep_secrets: bool = False) -> DataFrame:
    """Files variant: export blobs -> conformed dataset rows (+ ``_source``). A malformed line
    fails the load; with another ``mode`` use :func:`read_export_quarantine` to get such
    lines. ``keep_secrets`` leaves the credentials of scan definitions in."""
    ds = DATASETS[dataset]
    if ds.flatten == "av":
        lines = raw_lines(spark, paths, detect=detect)
        bad = F.call_function("try_parse_json", F.col("value")).isNull()
        if mode.upper() == "FAILFAST":
            lines = lines.withColumn("value", F.when(bad, F.raise_error(F.concat(
                F.lit("malformed JSON line in "), redact_url("path")))).otherwise(F.col("value")))
        else:
            lines = lines.where(~bad)
        return flatten_av_health(lines.select("value", redact_url("path").alias(SOURCE)), keep=[SOURCE])
    return _post(dataset, scan_export(spark, paths, contract(ds.contract), mode=mode, detect=detect), keep_secrets=keep_secrets)


def read_export_quarantine(spark: SparkSession, dataset: str, paths: list[str], *, detect: str = "content",
                           keep_secrets: bool = False) -> tuple[DataFrame, DataFrame]:
    """Files variant that keeps going: (conformed rows, malformed lines with their ``_source``)."""
    ds = DATASETS[dataset]
    if ds.flatten != "av":
        good, bad = scan_export_quarantine(spark, paths, contract(ds.contract), detect=detect)
        return _post(dataset, good, keep_secrets=keep_secrets), bad
    lines = raw_lines(spark, paths, detect=detect)
    bad = lines.where(F.call_function("try_parse_json", F.col("value")).isNull())
    return read_export(spark, dataset, paths, mode="PERMISSIVE", detect=detect), bad.select(redact_url("path").alias(SOURCE), F.col("value").alias(CORRUPT))


def read_pages(spark: SparkSession, dataset: str, paths: str | list[str], *, layout: str = "file", keep_secrets: bool = False) -> DataFrame:
    """Pages variant: landed page / single-object responses -> conformed rows (+ ``_source``)."""
    ds = DATASETS[dataset]
    return _post(dataset, scan_pages(spark, paths, contract(ds.contract), layout=layout), keep_secrets=keep_secrets)


def _post(dataset: str, df: DataFrame, *, keep_secrets: bool = False) -> DataFrame:
    if dataset == "scan_definitions" and not keep_secrets:
        df = redact_scan_secrets(df)
    return df


def redact_scan_secrets(df: DataFrame, column: str = "scanAuthenticationParams") -> DataFrame:
    """Null the credential fields inside the scan definitions' auth struct."""
    if column not in df.columns or not hasattr(df.schema[column].dataType, "fields"):
        return df
    fields = df.schema[column].dataType.fields  # type: ignore[attr-defined]
    rebuilt = F.struct(*[
        (F.lit(None).cast(f.dataType) if f.name in SCAN_SECRET_FIELDS else F.col(column).getField(f.name)).alias(f.name)
        for f in fields])
    return df.withColumn(column, F.when(F.col(column).isNull(), None).otherwise(rebuilt))


def conform_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """Conform any frame to a dataset's contract."""
    return conform(df, DATASETS[dataset].contract, keep=[SOURCE] if SOURCE in df.columns else None)
