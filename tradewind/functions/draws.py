"""Repeatable random draws as column expressions.

Every column of the generated tables has its own stream of a multiplicative
generator, x -> x * 16807 mod (2^31 - 1).  A row uses a fixed number of draws
of a stream, so its place in the stream follows from its row number, and any
task can jump there: 16807^e is put together from five lookup tables, one per
group of bits of e.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MULTIPLIER = 16807
MODULUS = 2147483647

# First state of each stream and the draws one row takes from it.
STREAMS: dict[str, tuple[int, int]] = {
    "p_mfgr": (1, 1), "p_brand": (46831694, 1), "p_type": (1841581359, 1),
    "p_size": (1193163244, 1), "p_container": (727633698, 1), "text": (933588178, 1),
    "p_comment": (804159733, 2), "ps_availqty": (1671059989, 4),
    "ps_supplycost": (1051288424, 4), "ps_comment": (1961692154, 8),
    "o_clerk": (1171034773, 1), "o_comment": (276090261, 2), "o_orderdate": (1066728069, 1),
    "l_quantity": (209208115, 7), "l_discount": (554590007, 7), "l_tax": (721958466, 7),
    "l_shipinstruct": (1371272478, 7), "l_shipmode": (675466456, 7),
    "l_partkey": (1808217256, 7), "l_suppkey": (2095021727, 7), "l_shipdate": (1769349045, 7),
    "l_commitdate": (904914315, 7), "l_receiptdate": (373135028, 7),
    "l_returnflag": (717419739, 7), "l_comment": (1095462486, 14),
    "c_address": (881155353, 9), "c_nationkey": (1489529863, 1), "c_phone": (1521138112, 3),
    "c_acctbal": (298370230, 1), "c_mktsegment": (1140279430, 1), "c_comment": (1335826707, 2),
    "s_address": (706178559, 9), "s_nationkey": (110356601, 1), "s_phone": (884434366, 3),
    "s_acctbal": (962338209, 1), "s_comment": (1341315363, 2), "p_name": (709314158, 92),
    "o_orderpriority": (591449447, 1), "o_custkey": (851767375, 1), "n_comment": (606179079, 2),
    "r_comment": (1500869201, 2), "o_lines": (1434868289, 1), "s_press_offset": (263032577, 1),
    "s_press_type": (753643799, 1), "s_press": (202794285, 1), "s_press_gap": (715851524, 1),
}

# How the 31 bits of an exponent are grouped, lowest first.
_BIT_GROUPS = (6, 6, 6, 6, 7)


def longs(values: list[int]) -> Column:
    """A constant array; one text literal that Catalyst folds into an array literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def jump(seed: int | Column, steps: Column) -> Column:
    """State of a stream ``steps`` draws after ``seed``."""
    exponent = F.pmod(steps.cast("bigint"), F.lit(MODULUS - 1).cast("bigint"))
    state = F.lit(seed).cast("bigint") if isinstance(seed, int) else seed
    shift = 0
    for bits in _BIT_GROUPS:
        powers = longs([pow(MULTIPLIER, digit << shift, MODULUS) for digit in range(1 << bits)])
        digit = F.shiftright(exponent, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        state = state * powers[digit] % F.lit(MODULUS)
        shift += bits
    return state


def positioned(frame: DataFrame, row: str, *streams: str) -> DataFrame:
    """Add the place of each row in the named streams, as columns ``_at<k>``.

    Streams that take k draws per row share 16807^(k * (row - 1)), and each
    such power is a few multiplications away from that of k = 1: a row jumps
    once, however many streams it reads.
    """
    frame = frame.withColumn("_at1", jump(1, F.col(row) - 1))
    for k in sorted({STREAMS[s][1] for s in streams} - {1}):
        frame = frame.withColumn(f"_at{k}", _power(F.col("_at1"), k))
    return frame


def _power(base: Column, exponent: int) -> Column:
    """base^exponent by halving the exponent."""
    if exponent == 1:
        return base
    half = _power(base, exponent // 2)
    square = half * half % F.lit(MODULUS)
    return square * base % F.lit(MODULUS) if exponent % 2 else square


def state(stream: str, nth: int | Column = 1) -> Column:
    """State after the ``nth`` draw of a ``positioned`` row."""
    seed, per_row = STREAMS[stream]
    ahead = [seed * pow(MULTIPLIER, k, MODULUS) % MODULUS for k in range(1, per_row + 1)]
    start = F.lit(ahead[nth - 1]).cast("bigint") if isinstance(nth, int) else (
        longs(ahead)[(nth - 1).cast("int")])
    return start * F.col(f"_at{per_row}") % F.lit(MODULUS)


def between(value: Column, low: int | Column, high: int | Column) -> Column:
    """A state scaled to a whole number within [low, high]."""
    low, high = (F.lit(b) if isinstance(b, int) else b for b in (low, high))
    share = value.cast("double") / F.lit(float(MODULUS))
    return low + F.floor(share * (high - low + 1).cast("double"))


def draw(stream: str, low: int | Column, high: int | Column, nth: int | Column = 1) -> Column:
    return between(state(stream, nth), low, high)


def weighted(words: list[tuple[str, int]]) -> Column:
    """Words repeated by weight: draw d in [1, total] picks element d - 1.

    This is the first word whose running weight reaches d, as one lookup.
    """
    return F.array(*[F.lit(w) for word, weight in words for w in [word] * weight])


def pick(stream: str, words: list[str] | list[tuple[str, int]],
         nth: int | Column = 1) -> Column:
    pairs = [w if isinstance(w, tuple) else (w, 1) for w in words]
    total = sum(weight for _, weight in pairs)
    return weighted(pairs)[(draw(stream, 1, total, nth) - 1).cast("int")]


def alias_table(weights: list[int]) -> tuple[list[int], list[int]]:
    """For each of as many slots as words, the share of the slot that is its own word's (in ``MODULUS``-ths), and whose the rest is.

    Every slot has the size of the average weight; what a light word leaves of its own is filled from a heavy one.  In whole
    numbers throughout, so each word gets its weight's share of all states to one state a slot.
    """
    total, n = sum(weights), len(weights)
    if total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative, and not all zero")
    left, own, other = [w * n for w in weights], [MODULUS] * n, list(range(n))
    light = [i for i, w in enumerate(left) if w < total]
    heavy = [i for i, w in enumerate(left) if w >= total]
    while light:
        small, large = light.pop(), heavy[-1]
        own[small], other[small] = left[small] * MODULUS // total, large
        left[large] -= total - left[small]
        if left[large] < total:
            light.append(heavy.pop())
    return own, other


def alias_pick(stream: str, words: list[tuple[str, int]], nth: int | Column = 1) -> Column:
    """A word by weight from two lookups, whatever the weights: the table has one entry a word.

    The words that ``pick`` chooses for the same draws are others; where values must be those, ``pick`` stays.
    """
    own, other = alias_table([weight for _, weight in words])
    scaled = state(stream, nth) * F.lit(len(words))
    slot, rest = F.floor(scaled / F.lit(MODULUS)).cast("int"), scaled % F.lit(MODULUS)
    place = F.when(rest < longs(own)[slot], slot).otherwise(longs(other)[slot].cast("int"))
    return F.array(*[F.lit(word) for word, _ in words])[place]


def sparse_key(index: Column, sequence: int | Column = 0) -> Column:
    """Spread keys: the low three bits stay, two sequence bits go in above them."""
    sequence = F.lit(sequence) if isinstance(sequence, int) else sequence
    upper = F.shiftleft(F.shiftright(index, 3), 2).bitwiseOR(sequence.cast("bigint"))
    return F.shiftleft(upper, 3).bitwiseOR(index.bitwiseAND(F.lit(7).cast("bigint")))
