"""Typed query models (Q1-Q14): one filter spec per entity.

A model holds optional field values plus ``page_size`` / ``top`` / ``skip`` /
``sinceTime``. ``predicate(schema)`` turns it into one conjunctive ``Column``
(F1-F6); ``apply(df)`` filters and, when ``top`` or ``skip`` is set, returns
exactly one ordered slice (L3). Value rules:

* str -> equality; datetime -> equality in UTC; list of str -> ``IN``;
* int / bool -> equality only when the frame's column is numeric / boolean
  (the upstream declares such fields but rejects them at serialisation);
* array columns -> ``array_contains`` (one value) / ``arrays_overlap`` (list);
* any other value type -> ``TypeError``; a value outside the field's enum
  domain -> ``ValueError``; an unknown field -> ``ValueError``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, BooleanType, NumericType, StructType

from ..plans.domains import DOMAINS
from . import predicates as P

LIST_PAGE_MAX = 10_000
EXPORT_PAGE_MAX = 200_000
TOP_MAX = 10_000


class EntityQuery:
    """Base class; subclasses set ``FIELDS`` (name -> enum domain or None)."""

    FIELDS: dict[str, str | None] = {}
    SINCE_COLUMN: str | None = None
    ORDER_BY: str = "id"
    PAGE_MAX: int = LIST_PAGE_MAX
    PAGE_DEFAULT: int | None = LIST_PAGE_MAX

    def __init__(self, *, page_size: int | None = -1, top: int | None = None,
                 skip: int | None = None, sinceTime: datetime | int | str | None = None,
                 **filters):
        if page_size == -1:
            page_size = self.PAGE_DEFAULT
        _check_range("page_size", page_size, 1, self.PAGE_MAX)
        _check_range("top", top, 1, TOP_MAX)
        _check_range("skip", skip, 0, None)
        unknown = sorted(set(filters) - set(self.FIELDS))
        if unknown:
            raise ValueError(f"{type(self).__name__}: unknown filter field(s) {unknown}")
        for name, value in filters.items():
            dom = self.FIELDS[name]
            if dom and value is not None:
                vals = value if isinstance(value, list) else [value]
                bad = [v for v in vals if isinstance(v, str) and v not in DOMAINS[dom]]
                if bad:
                    raise ValueError(f"{name}: {bad} not in domain {dom}")
        self.page_size = page_size
        self.top = top
        self.skip = skip
        self.sinceTime = sinceTime
        self.filters = {k: v for k, v in filters.items() if v is not None}

    def predicate(self, schema: StructType, *, now: datetime | None = None) -> Column | None:
        """The conjunctive filter for a frame with ``schema`` (None = no filter)."""
        types = {f.name: f.dataType for f in schema.fields}
        preds: list[Column | None] = [_field_predicate(n, v, types.get(n)) for n, v in self.filters.items()]
        if self.sinceTime is not None:
            if self.SINCE_COLUMN is None:
                raise ValueError(f"{type(self).__name__} has no time column for sinceTime")
            preds.append(P.since(self.SINCE_COLUMN, self.sinceTime, now=now))
        return P.all_of(preds)

    def apply(self, df: DataFrame, *, order_by: str | list[str] | None = None,
              now: datetime | None = None) -> DataFrame:
        """Filter ``df``; with ``top`` / ``skip`` return one ordered slice."""
        from ..operators.slicing import take_slice

        pred = self.predicate(df.schema, now=now)
        out = df.filter(pred) if pred is not None else df
        if self.top is not None or self.skip is not None:
            out = take_slice(out, order_by or self.ORDER_BY, top=self.top, skip=self.skip)
        return out


def _check_range(name: str, value: int | None, lo: int, hi: int | None) -> None:
    if value is None:
        return
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError(f"{name} must be an int")
    if value < lo or (hi is not None and value > hi):
        raise ValueError(f"{name}={value} outside [{lo}, {hi if hi is not None else 'inf'}]")


def _field_predicate(name: str, value, dtype) -> Column:
    is_array = isinstance(dtype, ArrayType)
    numeric_ok = isinstance(dtype, NumericType) or (is_array and isinstance(dtype.elementType, NumericType))
    bool_ok = isinstance(dtype, BooleanType)
    if isinstance(value, bool):
        if not bool_ok:
            raise TypeError(f"{name} cannot be filtered by {value!r}")
        return P.eq(name, value)
    if isinstance(value, str) or (isinstance(value, int) and numeric_ok):
        return P.array_has(name, value) if is_array else P.eq(name, value)
    if isinstance(value, datetime):
        return P.eq(name, value)
    if isinstance(value, list):
        if all(isinstance(v, str) for v in value) or (numeric_ok and all(isinstance(v, int) and not isinstance(v, bool) for v in value)):
            return P.array_has_any(name, value) if is_array else P.is_in(name, value)
    raise TypeError(f"{name} cannot be filtered by {value!r}")


def _model(name: str, fields: dict[str, str | None], **attrs) -> type[EntityQuery]:
    return type(name, (EntityQuery,), {"FIELDS": fields, **attrs})


# Allowed filter fields per entity and the enum domain each one is
# checked against (None = free text / typed value).
MachinesQuery = _model("MachinesQuery", {
    "computerDnsName": None, "id": None, "version": None, "deviceValue": "DEVICE_VALUE",
    "aadDeviceId": None, "machineTags": None, "lastSeen": None, "exposureLevel": "EXPOSURE_LEVEL",
    "onboardingStatus": "ONBOARDING_STATUS", "lastIpAddress": None, "healthStatus": "MACHINE_HEALTH_STATUS",
    "osPlatform": None, "riskScore": "RISK_SCORE", "rbacGroupId": None,
}, SINCE_COLUMN="lastSeen")
MachinesExportQuery = _model("MachinesExportQuery", {}, PAGE_MAX=EXPORT_PAGE_MAX, PAGE_DEFAULT=50_000,
                             SINCE_COLUMN="lastSeen")
AlertsQuery = _model("AlertsQuery", {
    "id": None, "alertCreationTime": None, "lastUpdateTime": None, "incidentId": None,
    "InvestigationId": None, "assignedTo": None, "detectionSource": None, "lastEventTime": None,
    "status": "ALERT_STATUS", "severity": "ALERT_SEVERITY", "category": None,
}, SINCE_COLUMN="alertCreationTime")
InvestigationQuery = _model("InvestigationQuery", {
    "id": None, "startTime": None, "state": "INVESTIGATION_STATE", "machineId": None, "triggeringAlertId": None,
})
MachineActionsQuery = _model("MachineActionsQuery", {
    "id": None, "status": "ACTION_STATUS", "machineId": None, "type": "ACTION_TYPE", "requestor": None,
    "creationDateTimeUtc": None,
})
IndicatorsQuery = _model("IndicatorsQuery", {
    "createdByDisplayName": None, "expirationTime": None, "generateAlert": None, "title": None,
    "rbacGroupNames": None, "rbacGroupIds": None, "indicatorValue": None,
    "indicatorType": "TI_INDICATOR_TYPE", "creationTimeDateTimeUtc": None, "createdBy": None,
    "action": "TI_INDICATOR_ACTION", "severity": "SEVERITY",
})
SoftwareQuery = _model("SoftwareQuery", {"id": None, "name": None, "vendor": None})
VulnerabilitiesQuery = _model("VulnerabilitiesQuery", {
    "id": None, "name": None, "description": None, "cvssV3": None, "publishedOn": None,
    "severity": None, "updatedOn": None,
})
VulnerabilitiesByMachineAndSoftwareQuery = _model("VulnerabilitiesByMachineAndSoftwareQuery", {
    "id": None, "cveId": None, "machineId": None, "fixingKbId": None, "productName": None,
    "productVersion": None, "severity": None, "productVendor": None,
})
RecommendationQuery = _model("RecommendationQuery", {
    "id": None, "productName": None, "vendor": None, "recommendedVersion": None,
    "recommendationCategory": None, "subCategory": None, "severityScore": None,
    "remediationType": None, "recommendedProgram": None, "recommendedVendor": None, "status": None,
})
RemediationQuery = _model("RemediationQuery", {"createdon": None, "status": None})
# Change feed (X1): rows at or after the bound on the event time.
VulnerabilityChangesQuery = _model("VulnerabilityChangesQuery", {
    "deviceId": None, "cveId": None, "status": None,
}, PAGE_MAX=EXPORT_PAGE_MAX, PAGE_DEFAULT=50_000, SINCE_COLUMN="eventTimestamp")
DeviceAVHealthQuery = _model("DeviceAVHealthQuery", {
    "machineId": None, "computerDnsName": None, "osKind": None, "osPlatform": None, "osVersion": None,
    "avMode": None, "avSignatureVersion": None, "avEngineVersion": None, "avPlatformVersion": None,
    "quickScanResult": None, "quickScanError": None, "fullScanResult": None, "fullScanError": None,
    "avIsSignatureUpToDate": None, "avIsEngineUpToDate": None, "avIsPlatformUpToDate": None,
    "rbacGroupId": None,
}, ORDER_BY="machineId")
BrowserExtensionsPermissionsInfoQuery = _model("BrowserExtensionsPermissionsInfoQuery", {
    "id": None, "name": None, "description": None, "cvssV3": None, "publishedOn": None,
    "severity": None, "updatedOn": None,
})
# Q14: paging only, no filter fields.
CertificateInventoryQuery = _model("CertificateInventoryQuery", {}, PAGE_DEFAULT=None)
DeviceAuthenticatedAgentsQuery = _model("DeviceAuthenticatedAgentsQuery", {}, PAGE_DEFAULT=None)
AuthenticatedDefinitionsQuery = _model("AuthenticatedDefinitionsQuery", {}, PAGE_DEFAULT=None)
AuthenticatedScanHistoryQuery = _model("AuthenticatedScanHistoryQuery", {}, PAGE_DEFAULT=None)
