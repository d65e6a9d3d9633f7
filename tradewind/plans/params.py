"""Parameters of the twenty-two questions: defaults, test values, random draws."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

from tradewind.functions import words as W

# The validation parameters of each question.
DEFAULTS: dict[str, dict] = {
    "q01": {"days": 90},
    "q02": {"size": 15, "metal": "BRASS", "region": "EUROPE"},
    "q03": {"segment": "BUILDING", "day": date(1995, 3, 15)},
    "q04": {"start": date(1993, 7, 1)},
    "q05": {"region": "ASIA", "start": date(1994, 1, 1)},
    "q06": {"start": date(1994, 1, 1), "discount": Decimal("0.06"), "quantity": 24},
    "q07": {"nation_a": "FRANCE", "nation_b": "GERMANY"},
    "q08": {"nation": "BRAZIL", "region": "AMERICA", "ptype": "ECONOMY ANODIZED STEEL"},
    "q09": {"word": "green"},
    "q10": {"start": date(1993, 10, 1)},
    "q11": {"nation": "GERMANY", "fraction": Decimal("0.0001")},
    "q12": {"mode_a": "MAIL", "mode_b": "SHIP", "start": date(1994, 1, 1)},
    "q13": {"first": "special", "second": "requests"},
    "q14": {"start": date(1995, 9, 1)},
    "q15": {"start": date(1996, 1, 1)},
    "q16": {"brand": "Brand#45", "ptype": "MEDIUM POLISHED",
            "sizes": (49, 14, 23, 45, 19, 3, 36, 9)},
    "q17": {"brand": "Brand#23", "container": "MED BOX"},
    "q18": {"quantity": 300},
    "q19": {"brands": ("Brand#12", "Brand#23", "Brand#34"), "quantities": (1, 10, 20)},
    "q20": {"word": "forest", "start": date(1994, 1, 1), "nation": "CANADA"},
    "q21": {"nation": "SAUDI ARABIA"},
    "q22": {"codes": ("13", "31", "23", "29", "30", "18", "17")},
}

# Values that select rows in the narrow test tables (other dates, numbered nations).
TEST_VALUES: dict[str, dict] = {
    **DEFAULTS,
    "q03": {"segment": "BUILDING", "day": date(1998, 3, 15)},
    "q04": {"start": date(1996, 7, 1)},
    "q05": {"region": "ASIA", "start": date(1996, 1, 1)},
    "q06": {"start": date(1996, 1, 1), "discount": Decimal("0.06"), "quantity": 24},
    "q07": {"nation_a": "NATION_6", "nation_b": "NATION_7"},
    "q08": {"nation": "NATION_2", "region": "AMERICA", "ptype": "ECONOMY ANODIZED STEEL"},
    "q09": {"word": "blue"},
    "q10": {"start": date(1996, 10, 1)},
    "q11": {"nation": "NATION_7", "fraction": Decimal("0.001")},
    "q12": {"mode_a": "MAIL", "mode_b": "SHIP", "start": date(1996, 1, 1)},
    "q16": {"brand": "Brand#14", "ptype": "MEDIUM POLISHED",
            "sizes": (49, 14, 23, 45, 19, 3, 36, 9)},
    "q18": {"quantity": 250},
    "q19": {"brands": ("Brand#9", "Brand#3", "Brand#24"), "quantities": (1, 15, 5)},
    "q20": {"word": "blue", "start": date(1996, 1, 1), "nation": "NATION_3"},
    "q21": {"nation": "NATION_7"},
}


def scaled_defaults(scale: float) -> dict[str, dict]:
    """Defaults for a scale factor: the stock fraction of q11 shrinks with it."""
    return {**DEFAULTS, "q11": {**DEFAULTS["q11"], "fraction": _fraction(scale)}}


def _fraction(scale: float) -> Decimal:
    return (Decimal("0.0001") / Decimal(str(scale))).quantize(Decimal("1e-10"))


def _month(rng: random.Random, low: int, high: int) -> date:
    """The first day of a month, as an offset from January 1993."""
    years, months = divmod(rng.randint(low, high), 12)
    return date(1993 + years, months + 1, 1)


def _year(rng: random.Random) -> date:
    return date(rng.randint(1993, 1997), 1, 1)


def _brand(rng: random.Random) -> str:
    return f"Brand#{rng.randint(1, 5)}{rng.randint(1, 5)}"


def _nation(rng: random.Random) -> str:
    return rng.choice(W.NATIONS)[0]


def _q07(rng: random.Random, scale: float) -> dict:
    (first, _), (second, _) = rng.sample(W.NATIONS, 2)
    return {"nation_a": first, "nation_b": second}


def _q08(rng: random.Random, scale: float) -> dict:
    nation, region = rng.choice(W.NATIONS)
    return {"nation": nation, "region": W.REGIONS[region], "ptype": rng.choice(W.part_types())}


def _q12(rng: random.Random, scale: float) -> dict:
    first, second = rng.sample(W.SHIP_MODES, 2)
    return {"mode_a": first, "mode_b": second, "start": _year(rng)}


# The published range of every parameter.  Country codes stay within 10-34,
# the codes that phone numbers can carry.
RANGES = {
    "q01": lambda r, s: {"days": r.randint(60, 120)},
    "q02": lambda r, s: {"size": r.randint(1, 50), "metal": r.choice(W.TYPE_METALS),
                         "region": r.choice(W.REGIONS)},
    "q03": lambda r, s: {"segment": r.choice(W.SEGMENTS),
                         "day": date(1995, 3, r.randint(1, 31))},
    "q04": lambda r, s: {"start": _month(r, 1, 58)},
    "q05": lambda r, s: {"region": r.choice(W.REGIONS), "start": _year(r)},
    "q06": lambda r, s: {"start": _year(r), "discount": Decimal(r.randint(2, 9)) / 100,
                         "quantity": r.randint(24, 25)},
    "q07": _q07,
    "q08": _q08,
    "q09": lambda r, s: {"word": r.choice(W.COLOURS)},
    "q10": lambda r, s: {"start": _month(r, 1, 24)},
    "q11": lambda r, s: {"nation": _nation(r), "fraction": _fraction(s)},
    "q12": _q12,
    "q13": lambda r, s: {"first": r.choice(W.COMMENT_FIRST),
                         "second": r.choice(W.COMMENT_SECOND)},
    "q14": lambda r, s: {"start": _month(r, 0, 59)},
    "q15": lambda r, s: {"start": _month(r, 0, 57)},
    "q16": lambda r, s: {"brand": _brand(r),
                         "ptype": r.choice(W.part_types()).rsplit(" ", 1)[0],
                         "sizes": tuple(r.sample(range(1, 51), 8))},
    "q17": lambda r, s: {"brand": _brand(r), "container": r.choice(W.containers())},
    "q18": lambda r, s: {"quantity": r.randint(312, 315)},
    "q19": lambda r, s: {"brands": (_brand(r), _brand(r), _brand(r)),
                         "quantities": (r.randint(1, 10), r.randint(10, 20),
                                        r.randint(20, 30))},
    "q20": lambda r, s: {"word": r.choice(W.COLOURS), "start": _year(r),
                         "nation": _nation(r)},
    "q21": lambda r, s: {"nation": _nation(r)},
    "q22": lambda r, s: {"codes": tuple(str(c) for c in r.sample(range(10, 35), 7))},
}


def draw(name: str, rng: random.Random, scale: float = 1.0) -> dict:
    """One random parameter set within the published ranges of a question."""
    return RANGES[name](rng, scale)
