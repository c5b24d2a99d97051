"""Synthetic sales rows with known faults.

Every value is a function of the row id and the seed, so a task that runs again
yields the same rows, and nothing is shuffled. Exact fault counts come from a
permutation of the ids 0..n-1: the ids it sends below k are exactly k rows.
Over ids with gaps, ``smallest_hashes`` finds the hash below which exactly k rows
lie by counting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd, pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.numbers import clip
from salesflow.functions.text import padded_key
from salesflow.rules import AMOUNT_HIGH, AMOUNT_LOW, CATEGORIES, CATEGORY_WEIGHTS, REGION_WEIGHTS, REGIONS

# Distribution parameters and fault rates.
LOG_MEAN, LOG_SIGMA = 4.0, 1.2
CUSTOMERS = 100_000
FIRST_SECOND, LAST_SECOND = "2022-01-01 00:00:00", "2024-12-31 23:59:59"
SECONDS = 94_694_399
NULL_SHARE, RESEND_SHARE = 0.01, 0.005


def uniform(row_id: Column, seed: int, stream: str) -> Column:
    """A number in [0, 1) that depends on the id, the seed and the stream only."""
    bits = F.shiftrightunsigned(F.xxhash64(row_id, F.lit(seed), F.lit(stream)), 11)
    return bits.cast("double") / F.lit(float(2**53))


HASH_BITS, DIGIT_BITS = 52, 13


def counter_bits(row_id: Column, seed: int, stream: str) -> Column:
    """A whole number of HASH_BITS bits from the MD5 of ``seed:stream:id``, which any engine can repeat."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(stream), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def counter_uniform(row_id: Column, seed: int, stream: str) -> Column:
    """Like ``uniform``, slower, from ``counter_bits``."""
    return counter_bits(row_id, seed, stream).cast("double") / F.lit(float(2**HASH_BITS))


def weighted_choice(u: Column, values: Sequence[str], weights: Sequence[float]) -> Column:
    """Pick a value by where ``u`` falls in the cumulated weights."""
    reached, choice = 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        reached += weight
        inside = u < reached
        choice = F.when(inside, value) if choice is None else choice.when(inside, value)
    return F.lit(values[-1]) if choice is None else choice.otherwise(values[-1])


def lognormal(u1: Column, u2: Column, mean: float = LOG_MEAN, sigma: float = LOG_SIGMA) -> Column:
    """Log-normal draw from two uniforms."""
    normal = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2 * pi) * u2)
    return F.exp(F.lit(mean) + F.lit(sigma) * normal)


def uuid_like(row_id: Column, seed: int) -> Column:
    """A 36-character id from the row id and the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def exact_sample(row_id: Column, n: int, size: int, seed: int) -> Column:
    """True for exactly ``size`` of the ids 0..n-1, spread over the whole range."""
    if n <= 1:
        return F.lit(size >= n)
    # The step stays small enough that id * step fits a long.
    bound = max(2, min(n, (2**62) // n))
    step = max(1, int(bound * (0.618033988749895 - 0.01 * (seed % 23))))
    while gcd(step, n) != 1:
        step += 1
    position = F.pmod(row_id * F.lit(step) + F.lit((seed * 7919) % n), F.lit(n))
    return position < F.lit(size)


def smallest_hashes(rows: DataFrame, size: int, seed: int, stream: str = "sample") -> Column:
    """A condition on ``id`` that holds for exactly ``size`` rows of whatever unique ids: those of the smallest hashes, ties by id.

    Nothing is sorted or shuffled but counts: a pass counts rows by the leading digit of the hash and finds the digit in
    which the last row lies; further passes count only within that digit, until it is used up at its end.
    Rows of one id are taken together or left together. Runs up to four jobs of 8,192 counts each.
    """
    place, digits = counter_bits(F.col("id"), seed, stream), HASH_BITS // DIGIT_BITS
    if size <= 0:
        return F.lit(False)
    wanted, prefix = size, 0
    for level in range(1, digits + 1):
        shift = HASH_BITS - level * DIGIT_BITS
        number = F.shiftright(place, shift)
        within = rows if level == 1 else rows.filter(F.shiftright(place, shift + DIGIT_BITS) == prefix)
        counts = sorted((r.number, r["count"]) for r in within.groupBy(number.alias("number")).count().collect())
        for bucket, rows_in in counts:
            if wanted <= rows_in:
                break
            wanted -= rows_in
        else:
            return F.lit(True)  # fewer rows than wanted: only the first pass can end here
        prefix = bucket
        if wanted == rows_in:
            return F.shiftright(place, shift) <= prefix
    tied = rows.filter(place == prefix).select("id").distinct().orderBy("id").limit(wanted).collect()  # ids of one 52-bit hash
    return (place < prefix) | F.col("id").isin([r.id for r in tied])


def moment_at(u: Column) -> Column:
    """The second that lies at the share ``u`` of the time span."""
    start = F.unix_timestamp(F.lit(FIRST_SECOND).cast("timestamp"))
    return F.timestamp_seconds(start + F.floor(u * SECONDS))


def sales_rows(
    ids: DataFrame, seed: int = 42, style: str = "uuid", customers: int = CUSTOMERS, draw: Callable[[Column, int, str], Column] = uniform,
) -> DataFrame:
    """Faultless sales rows for the ``id`` column of a frame.

    ``style`` is ``uuid`` (UUID-shaped keys, ``CUST_000001``) or ``serial``
    (``TXN-<run>-000000001``, ``CUST-000001``). ``draw`` yields the random numbers.
    """
    i = F.col("id")
    number = (F.floor(draw(i, seed, "customer") * customers) + 1).cast("bigint")
    if style == "uuid":
        key, customer = uuid_like(i, seed), padded_key("CUST_", number, 6)
    else:
        run = (seed * 7919) % 999_999
        key, customer = padded_key(f"TXN-{run:06d}-", i, 9), padded_key("CUST-", number, 6)
    amount = F.round(lognormal(draw(i, seed, "amount-1"), draw(i, seed, "amount-2")), 2)
    moment = moment_at(draw(i, seed, "moment"))
    return ids.select(
        i,
        key.alias("transaction_id"),
        customer.alias("customer_id"),
        weighted_choice(draw(i, seed, "category"), CATEGORIES, CATEGORY_WEIGHTS).alias("product_category"),
        clip(amount, AMOUNT_LOW, AMOUNT_HIGH).alias("amount"),
        moment.alias("timestamp"),
        weighted_choice(draw(i, seed, "region"), REGIONS, REGION_WEIGHTS).alias("region"),
    )


def _picked(rows: DataFrame, n: int | None, share: float, seed: int) -> Column:
    """A condition for ``floor(n * share)`` of the ids 0..n-1, or without ``n`` for that share of whatever ids ``rows`` has."""
    if n is None:
        return smallest_hashes(rows, int(rows.count() * share), seed)
    return exact_sample(F.col("id"), n, int(n * share), seed)


def inject_nulls(rows: DataFrame, n: int | None, seed: int = 42, share: float = NULL_SHARE) -> DataFrame:
    """NULL in exactly ``floor(n * share)`` amounts and, independently, as many customers; without ``n``, of rows with any unique ids."""
    ids = rows.select("id")
    return rows.withColumns({
        "amount": F.when(~_picked(ids, n, share, seed + 1), F.col("amount")),
        "customer_id": F.when(~_picked(ids, n, share, seed + 2), F.col("customer_id")),
    })


def resends(rows: DataFrame, n: int | None, seed: int = 42, share: float = RESEND_SHARE) -> DataFrame:
    """Exactly ``floor(n * share)`` of the rows, as an upstream system would send them again; without ``n``, of rows with any unique ids."""
    return rows.filter(_picked(rows.select("id"), n, share, seed + 3))


def generate_from_ids(ids: DataFrame, n: int | None = None, seed: int = 42, **options) -> DataFrame:
    """Sales rows for ids 0..n-1, or without ``n`` for any unique ids, with NULLs and re-sent rows."""
    faulty = inject_nulls(sales_rows(ids, seed, **options), n, seed)
    return faulty.unionByName(resends(faulty, n, seed)).drop("id")


def generate_sales(spark: SparkSession, n: int, seed: int = 42, **options) -> DataFrame:
    """``n`` sales rows plus re-sent copies."""
    return generate_from_ids(spark.range(n), n, seed, **options)
