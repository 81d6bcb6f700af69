import pytest
from pyspark.sql.types import StructType

from fleetlake.operators import quality as Q
from fleetlake.operators.conform import conform


def as_dict(df, k="column"):
    return {r[k]: r.violations for r in df.collect()}


def test_drift(spark):
    obs = StructType.fromDDL("id STRING, extra STRING, u STRUCT<a: BIGINT, z: STRING>")
    exp = StructType.fromDDL("id STRING, name STRING, u STRUCT<a: INT, b: STRING>")
    rows = {(r.path, r.kind) for r in Q.schema_drift(spark, obs, exp).collect()}
    assert rows == {("name", "missing"), ("u.b", "missing"), ("extra", "extra"), ("u.z", "extra")}


def test_nullability_and_nested(spark):
    df = spark.createDataFrame([("a1", None, "New", [{"comment": "c", "createdBy": "x", "createdTime": None}]),
                                (None, "High", None, None)],
                               "id string, severity string, status string, "
                               "comments array<struct<comment:string,createdBy:string,createdTime:timestamp>>")
    rep = as_dict(Q.nullability_report(conform(df, "alert"), "alert"))
    assert rep["id"] == 1 and rep["severity"] == 1 and rep["status"] == 1 and rep["comments[].createdTime"] == 1
    assert rep["evidence[].entityType"] == 0


def test_coercion_loss_and_domains(spark):
    wire = spark.createDataFrame([("7", "x"), ("7.5", "High"), (None, "Medium")], "n string, sev string")
    assert as_dict(Q.coercion_loss_report(wire, StructType.fromDDL("n INT, sev STRING"))) == {"n": 1, "sev": 0}
    assert as_dict(Q.domain_report(wire, {"sev": "SEVERITY"})) == {"sev": 1}
    assert Q.domain_violations(wire, "sev", "SEVERITY").count() == 1


def test_variant_merge(spark):
    base = StructType.fromDDL("type STRING, keyVaultUri STRING")
    merged = Q.merge_variant_schemas(base, [StructType.fromDDL("type STRING, username STRING"),
                                            StructType.fromDDL("privateKey STRING, username STRING")])
    assert merged.fieldNames() == ["type", "keyVaultUri", "username", "privateKey"]
    with pytest.raises(TypeError):
        Q.merge_variant_schemas(base, [StructType.fromDDL("type INT")])
    a = spark.createDataFrame([("Ntlm", "u")], "type string, username string")
    b = spark.createDataFrame([("PrivateKey", "k")], "type string, privateKey string")
    assert Q.union_variants([a, b]).count() == 2


def test_auth_variants(spark):
    schema = ("p struct<keyVaultUri:string,keyVaultSecretName:string,type:string,username:string,password:string,"
              "domain:string,isgmsaUser:boolean,packetPrivacy:boolean,packetIntegrity:boolean,privateKey:string,"
              "communityString:string>")
    rows = [((None, None, "Negotiate", "u", None, None, False, False, False, None, None),),
            ((None, None, "PrivateKey", "u", None, None, None, None, None, "k", None),),
            ((None, None, "PrivateKey", "u", None, "CORP", None, None, None, None, None),),
            ((None, None, "Bogus", None, None, None, None, None, None, None, None),)]
    out = Q.auth_variant_violations(spark.createDataFrame(rows, schema), "p").collect()
    assert [len(r.authErrors) for r in out] == [0, 0, 1, 1]
    assert "domain" in out[2].authErrors[0]


def test_validate_rows_and_reconcile(spark):
    df = spark.createDataFrame([("v", "Url", "Block"), ("", "Url", "Nope"), (None, None, "Block")],
                               "indicatorValue string, indicatorType string, action string")
    valid, rejected = Q.validate_rows(df, [Q.required("indicatorValue"), Q.min_length("indicatorValue"),
                                           Q.in_domain("action", "TI_INDICATOR_ACTION")])
    assert valid.count() == 1
    errs = sorted(len(r.errors) for r in rejected.collect())
    assert errs == [1, 2]
    left = spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, "c", 1)], "k int, s string, n int")
    right = spark.createDataFrame([(1, "a", 10), (2, "B", None), (4, "d", 1)], "k int, s string, n int")
    rows = {(r.k, r.column, r.left, r.right) for r in Q.reconcile(left, right, "k").collect()}
    assert rows == {(2, "s", "b", "B"), (3, "_row", "present", "absent"), (4, "_row", "absent", "present")}
