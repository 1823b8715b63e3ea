import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators.partners import add_bp_columns, entity_json, unify
from tidemark.schemas import SOURCE_FIELDS

NOW = "2024-02-01 00:00:00"
FIELDS = ["sap_client", "bp_number", "event_type", "source_table", "kafka_offset", "bp_category",
          "full_name", "first_name", "last_name", "country_code", "region", "tax_number",
          "created_date", "changed_date", "is_active"]
SCHEMA = ", ".join(
    f"{f} " + {"kafka_offset": "bigint", "is_active": "boolean"}.get(f, "string") for f in FIELDS
)


def row(number, source, offset, event="UPDATE", client="100", **values):
    values |= {"sap_client": client, "bp_number": number, "source_table": source,
               "kafka_offset": offset, "event_type": event}
    return tuple(values.get(f) for f in FIELDS)


def trusted(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "kafka_ingest_timestamp": F.lit("2024-01-01").cast("timestamp"),
        "kafka_partition": F.lit(0),
    })
    return add_bp_columns(df, NOW)


def many_rows(seed, n=400):
    """A third of the rows belong to one partner; some have no number or an unused source."""
    rng = random.Random(seed)
    rows = []
    for offset in range(n):
        number = "hot" if rng.random() < 0.34 else rng.choice([None, *map(str, range(40))])
        rows.append(row(
            number, rng.choice(["BUT000", "KNA1", "LFA1", "KNVV", None]), offset,
            rng.choice(["INSERT", "UPDATE", "DELETE", None]), rng.choice(["100", "200", None]),
            full_name=rng.choice(["Name A", "Name B", None]), first_name=rng.choice(["F", None]),
            last_name=rng.choice(["L", None]), country_code=rng.choice(["BR", None]),
            region=rng.choice(["SP", None]), tax_number=rng.choice(["T1", None]),
            bp_category=rng.choice(["1", None]), is_active=rng.choice([True, False, None]),
        ))
    return rows


def by_hand(rows, drop_deleted=False):
    newest = {}
    for r in sorted((dict(zip(FIELDS, r)) for r in rows), key=lambda r: r["kafka_offset"]):
        newest[r["sap_client"], r["bp_number"], r["source_table"]] = r
    out = {}
    for (client, number, source), base in newest.items():
        if source != "BUT000" or (drop_deleted and base["event_type"] == "DELETE"):
            continue
        known = client is not None and number is not None
        customer = newest.get((client, number, "KNA1"), {}) if known else {}
        vendor = newest.get((client, number, "LFA1"), {}) if known else {}
        person = " ".join(filter(None, (base["first_name"], base["last_name"]))) or None
        out[client, number] = (
            base["bp_category"], base["first_name"], base["last_name"], base["is_active"],
            customer.get("full_name"), customer.get("country_code"), customer.get("region"),
            vendor.get("full_name"), vendor.get("tax_number"),
            customer.get("full_name") or vendor.get("full_name") or person,
        )
    return out


def collected(df):
    out = {}
    for r in df.collect():
        assert (r.sap_client, r.bp_number) not in out, "one record per partner"
        out[r.sap_client, r.bp_number] = (
            r.bp_category, r.first_name, r.last_name, r.is_active, r.customer_name,
            r.customer_country, r.customer_region, r.vendor_name, r.vendor_tax_id, r.unified_name,
        )
    return out


@pytest.mark.parametrize("how", ["pivot", "join"])
@pytest.mark.parametrize("drop_deleted", [False, True])
def test_one_record_per_partner_by_hand(spark, how, drop_deleted):
    rows = many_rows(1)
    got = collected(unify(trusted(spark, rows), NOW, how=how, drop_deleted=drop_deleted))
    assert got == by_hand(rows, drop_deleted)


def test_pivot_reads_the_input_once_and_cuts_before_the_shuffle(spark, plan, folder):
    trusted(spark, many_rows(2)).write.parquet(folder)
    stored = spark.read.parquet(folder)
    text = plan(unify(stored, NOW))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "partial_max_by" in text.split("Exchange")[1]
    assert plan(unify(stored, NOW, how="join")).count("FileScan") == 3


def test_another_source_is_only_configuration(spark):
    rows = [row("1", "BUT000", 1), row("1", "KNVV", 2, region="EMEA")]
    sources = {**SOURCE_FIELDS, "KNVV": {"sales_region": "region"}}
    for how in ("pivot", "join"):
        record = unify(trusted(spark, rows), NOW, how=how, sources=sources).first()
        assert record.sales_region == "EMEA"


def test_names_fall_back_and_may_be_missing(spark):
    rows = [
        row("1", "BUT000", 1, first_name="Ann", last_name="Lee"),
        row("1", "KNA1", 2, full_name="Customer"), row("1", "LFA1", 3, full_name="Vendor"),
        row("2", "BUT000", 4, first_name="Ann"), row("2", "LFA1", 5, full_name="Vendor"),
        row("3", "BUT000", 6, last_name="Lee"), row("4", "BUT000", 7),
    ]
    names = {r.bp_number: r.unified_name for r in unify(trusted(spark, rows), NOW).collect()}
    assert names == {"1": "Customer", "2": "Vendor", "3": "Lee", "4": None}


def test_unreadable_dates_are_null(spark):
    rows = [row(str(i), "BUT000", i, created_date=text) for i, text in enumerate(
        ["20240131", "00000000", "2024-01-31", "", None])]
    dates = [r.created_date_parsed for r in
             trusted(spark, rows).orderBy("kafka_offset").collect()]
    assert dates == [date(2024, 1, 31), None, None, None, None]


def test_entity_text_leaves_nulls_out(spark):
    rows = [row("1", "BUT000", 1, created_date="20240131", is_active=True)]
    record = json.loads(entity_json(unify(trusted(spark, rows), NOW)).first().entity_json)
    assert record == {
        "sap_client": "100", "bp_number": "1", "is_active": True,
        "created_date_parsed": "2024-01-31", "gold_processed_at": "2024-02-01T00:00:00.000Z",
    }
