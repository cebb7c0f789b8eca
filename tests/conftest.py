import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

CDR_DDL = ("call_id string, msisdn string, timestamp string, service_type string, volume double, "
           "expected_charge double, data_quality string, status string, partition_date date, "
           "_rescued_data string, bronze_source_file string")
EDR_DDL = ("session_id string, msisdn string, cdr_call_id string, timestamp string, charge_amount double, "
           "payment_method string, billing_status string, transaction_id string, data_quality string, "
           "bronze_source_file string")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from reconlake.session import _checkpoint_root, ensure_session
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "4")      # each is four state stores of the stream join
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_session(s)
    _checkpoint_root(s)      # the configured spark.checkpoint.dir, or a new folder if none is set
    yield s


def cdr_row(call_id="CALL-000000000001", msisdn="+35800010000", ts="2024-01-05T10:00:00.000000",
            service_type="voice", volume=10.0, expected_charge=0.5, data_quality="GOOD", status="COMPLETED",
            partition_date=None, path="/bronze/cdr-events/2024-01-05/part.parquet"):
    import datetime as dt
    pd_ = dt.date.fromisoformat(partition_date) if isinstance(partition_date, str) else partition_date
    return (call_id, msisdn, ts, service_type, volume, expected_charge, data_quality, status, pd_, None, path)


def edr_row(session_id="SESSION-000000000001", msisdn="+35800010000", cdr_call_id="CALL-000000000001",
            ts="2024-01-05T10:01:00.000000", charge_amount=0.5, payment_method="PREPAID_DEDUCT",
            billing_status="SUCCESS", transaction_id="TX-1", data_quality="GOOD", path="/bronze/edr-events/p.parquet"):
    return (session_id, msisdn, cdr_call_id, ts, charge_amount, payment_method, billing_status, transaction_id,
            data_quality, path)


def frames(spark, cdr_rows, edr_rows):
    """Silver-shaped usage and charge frames from literal raw rows."""
    from reconlake.functions import clean
    cdr = clean.clean_cdr(spark.createDataFrame(cdr_rows, CDR_DDL))
    edr = clean.clean_edr(spark.createDataFrame(edr_rows, EDR_DDL))
    return cdr, edr
