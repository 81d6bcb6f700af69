import pytest

from fleetlake.plans.contracts import (UnknownContractError, contract, contract_names, required_columns,
                                       required_nested)
from fleetlake.plans.domains import DOMAINS


def test_all_contracts_parse(spark):
    names = [n for n in contract_names() if n != "import_indicator_result"]
    assert len(names) == 51
    assert sum(len(contract(n).fields) for n in names) == 648


def test_required_and_nested(spark):
    assert required_columns("alert") == ["id", "severity", "status"]
    nested = required_nested("alert")
    assert nested["comments"] == ["createdTime"]
    assert nested["evidence"] == ["entityType", "evidenceCreationTime"]
    assert "cloudProvider" in required_nested("machine")["vmMetadata"]


def test_unknown_contract_is_error(spark):
    with pytest.raises(UnknownContractError):
        contract("nope")


def test_domains():
    assert DOMAINS["MACHINE_HEALTH_STATUS"][0] == "Active"
    assert "Remove" in DOMAINS["TAG_ACTION"]
