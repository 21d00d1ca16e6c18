import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# The 40-row sample exports (20 bank rows, 20 card rows).
SAMPLE_BANK_CSV = """transaction_id,date,description,amount,transaction_type,balance
TXN-001,2024-01-02,DIRECT DEPOSIT - EMPLOYER PAYROLL,3250.00,credit,3250.00
TXN-002,2024-01-03,WALMART SUPERCENTER #4821,-87.43,debit,3162.57
TXN-003,2024-01-05,NETFLIX.COM,-15.99,debit,3146.58
TXN-004,2024-01-06,SHELL OIL 57442,-54.20,debit,3092.38
TXN-005,2024-01-07,CHIPOTLE MEXICAN GRILL,-13.75,debit,3078.63
TXN-006,2024-01-08,ATM WITHDRAWAL - MAIN ST BRANCH,-100.00,debit,2978.63
TXN-007,2024-01-10,FLORIDA POWER & LIGHT,-124.50,debit,2854.13
TXN-008,2024-01-11,KROGER #0342,-63.18,debit,2790.95
TXN-009,2024-01-12,SPOTIFY USA,-9.99,debit,2780.96
TXN-010,2024-01-14,TRANSFER TO SAVINGS,-500.00,debit,2280.96
TXN-011,2024-01-15,AMAZON.COM PURCHASE,-34.99,debit,2245.97
TXN-012,2024-01-16,DIRECT DEPOSIT - EMPLOYER PAYROLL,3250.00,credit,5495.97
TXN-013,2024-01-17,COMCAST CABLE,-89.99,debit,5405.98
TXN-014,2024-01-19,WHOLEFDS MKT #10452,-112.34,debit,5293.64
TXN-015,2024-01-20,UBER *TRIP,-18.50,debit,5275.14
TXN-016,2024-01-22,VENMO PAYMENT RECEIVED,75.00,credit,5350.14
TXN-017,2024-01-24,PLANET FITNESS,-24.99,debit,5325.15
TXN-018,2024-01-25,TARGET STORE #2281,-47.62,debit,5277.53
TXN-019,2024-01-28,PROGRESSIVE INSURANCE,-142.00,debit,5135.53
TXN-020,2024-01-30,INTEREST PAYMENT,3.12,credit,5138.65
"""

SAMPLE_CARD_CSV = """transaction_id,post_date,merchant_name,merchant_category,amount,transaction_type,statement_balance
CC-001,2024-01-03,MCDONALD'S #3847,Dining,8.45,debit,8.45
CC-002,2024-01-04,AMAZON.COM,Shopping,67.32,debit,75.77
CC-003,2024-01-05,RACETRAC #1092,Gas & Transport,48.10,debit,123.87
CC-004,2024-01-06,PUBLIX SUPER MARKETS,Groceries,94.21,debit,218.08
CC-005,2024-01-08,ADOBE INC,Subscriptions,54.99,debit,273.07
CC-006,2024-01-09,OLIVE GARDEN 0094,Dining,43.60,debit,316.67
CC-007,2024-01-10,CVS PHARMACY #8812,Health,22.47,debit,339.14
CC-008,2024-01-11,DELTA AIR LINES,Travel,284.00,debit,623.14
CC-009,2024-01-13,STARBUCKS #11204,Dining,6.85,debit,629.99
CC-010,2024-01-14,APPLE.COM/BILL,Subscriptions,2.99,debit,632.98
CC-011,2024-01-15,PAYMENT RECEIVED - THANK YOU,,-632.98,credit,0.00
CC-012,2024-01-16,HOME DEPOT #0451,Home Improvement,113.76,debit,113.76
CC-013,2024-01-17,CHICK-FIL-A #02847,Dining,11.34,debit,125.10
CC-014,2024-01-19,COSTCO WHSE #0842,Groceries,187.43,debit,312.53
CC-015,2024-01-20,LYFT *RIDE,Gas & Transport,14.25,debit,326.78
CC-016,2024-01-22,HULU,Subscriptions,17.99,debit,344.77
CC-017,2024-01-23,WALGREENS #4521,Health,31.18,debit,375.95
CC-018,2024-01-25,CHEESECAKE FACTORY,Dining,67.40,debit,443.35
CC-019,2024-01-27,BEST BUY 00031,Shopping,129.99,debit,573.34
CC-020,2024-01-29,FOREIGN TRANSACTION FEE,Fees,3.50,debit,576.84
"""


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tally.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tally-test-ckpt-")
    # Only set a checkpoint folder of our own when the environment has none.
    extra = {}
    probe = SparkSession.getActiveSession()
    if probe is None:
        extra = {"spark.driver.memory": "4g"}
    s = build_session("local[*]", app="tally-tests", shuffle_partitions=8, extra=extra)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture()
def scratch(spark):
    from tally.session import scratch_path
    return lambda name: scratch_path(spark, name)


@pytest.fixture(scope="session")
def sample_paths():
    d = tempfile.mkdtemp(prefix="tally-sample-")
    bank = os.path.join(d, "sample_bank.csv")
    card = os.path.join(d, "sample_card.csv")
    with open(bank, "w") as f:
        f.write(SAMPLE_BANK_CSV)
    with open(card, "w") as f:
        f.write(SAMPLE_CARD_CSV)
    return {"bank": bank, "card": card, "dir": d}


def raw_frame(spark, rows, source):
    """Raw-contract rows from (id, 'YYYY-MM-DD', description, amount, type)."""
    from pyspark.sql import functions as F

    from tally.sources.raw import to_raw_contract
    df = spark.createDataFrame(rows, "transaction_id string, date string, description string, "
                                     "amount double, transaction_type string")
    return to_raw_contract(df.withColumn("date", F.col("date").cast("timestamp_ntz"))
                           .withColumn("source", F.lit(source)))
