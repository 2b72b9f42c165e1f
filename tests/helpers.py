"""Hand-made raw logs and small utilities."""

from logtide.constants import TRANSFER_SIGNATURE, TRANSFER_TOPIC
from logtide.schemas import EVENT_SIGNATURES, RAW_LOGS

ALICE, BOB, ZERO = 0xA11CE, 0xB0B, 0


def word(number: int) -> bytearray:
    return bytearray(number.to_bytes(32, "big"))


def log(
    index=0, block=1, sender=ALICE, receiver=BOB, value=10**18, removed=False, tx=None,
    topic0=TRANSFER_TOPIC, data=None,
):
    return (
        removed,
        index,
        0,
        word(block * 1000 + index if tx is None else tx),
        word(block),
        block,
        bytearray((7).to_bytes(20, "big")),
        word(value) if data is None else bytearray(data),
        bytearray.fromhex(topic0[2:]),
        None if sender is None else word(sender),
        None if receiver is None else word(receiver),
    )


def logs(spark, rows):
    return spark.createDataFrame(rows, RAW_LOGS)


def signatures(spark, rows=((TRANSFER_TOPIC, "Transfer", TRANSFER_SIGNATURE),)):
    return spark.createDataFrame(list(rows), EVENT_SIGNATURES)


def address(number: int) -> str:
    return f"0x{number:040x}"


def tuples(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
