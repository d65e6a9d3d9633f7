import hashlib
import itertools
import random
import re
import zlib

import pytest
from cases import LONG, documents

from tradewind.llm import repair as R

ROLES = ["system", "user", "assistant", "tool", "", "u2"]
TEXTS = ["Done.", "Really?", "cut", " \t", "", "Done. \n", "same!", "same!"]


def facts(rows):
    """First faults, counts and illegal neighbours of (turn, role, text) in order, by plain loops."""
    seen, found = [], []
    for _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else "")
        seen.append((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return found, (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal)


def brute(rows):
    """Cost, audit and text of the best of all edits, with up to two inserts at every place."""
    found, _ = facts(rows)
    choices = []
    for (_, role, text), fault in zip(rows, found):
        more = 3 if fault == "truncated" else 0
        ways = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            ways += [("K", more, (role, text))] + [("R", 3 + more, (r, text)) for r in ("user", "assistant")]
        choices.append(ways)
    inserts = [[("I", 3, (r, "")) for r in roles] for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for edits in itertools.product(*choices):
        for extra in itertools.product(inserts, repeat=len(rows) + 1):
            path = [*extra[0]]
            for edit, more in zip(edits, extra[1:]):
                path += [edit, *more]
            cost = sum(p[1] for p in path)
            if best is None or cost <= best[0]:
                kept = [p[2] for p in path if p[2]]
                initials = [r[:1] for r, _ in kept]
                if "" not in initials and re.fullmatch("(s?(ua)+)?", "".join(initials)):
                    own = (cost, "".join(p[0] for p in path), "\n".join(f"{r}:{t}" for r, t in kept))
                    best = min(best or own, own)
    return best


def by_loop(rows):
    found, counts = facts(rows)
    report = R.Report(1)
    report.block([t for t, *_ in rows], [r for _, r, _ in rows], [t for *_, t in rows], set(), R.TO_END, True)
    return counts, report


def random_rows(draw, n):
    return sorted(((draw.choice([None, draw.randint(0, 9)]), draw.choice(ROLES), draw.choice(TEXTS)) for _ in range(n)),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


@pytest.mark.parametrize("n, cases", [(0, 1), (1, 60), (2, 150), (3, 12)])
def test_least_path_equals_all_paths(n, cases):
    draw = random.Random(n)
    for _ in range(cases):
        rows = random_rows(draw, n)
        cost, audit, whole = brute(rows)
        counts, report = by_loop(rows)
        assert report.row() == (1, *counts, cost, audit, hashlib.sha256(whole.encode()).hexdigest()), rows


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def test_blocks_equal_one_block(spark, monkeypatch):
    """Conversations cut into blocks of five rows, over several tasks, one of them with most of the rows."""
    draw = random.Random(8)
    talks = {conv: random_rows(draw, draw.randint(1, 12)) for conv in range(40)}
    talks[None] = random_rows(draw, 7)
    talks[99] = random_rows(draw, 400)
    want = {}
    for conv, rows in talks.items():
        rows = sorted_rows(rows)
        counts, report = by_loop(rows)
        want[conv] = report.row()[1:]
    monkeypatch.setattr(R, "ROWS", 5)
    monkeypatch.setattr(R, "CHARS", 60)
    rows = spark.createDataFrame([(c, *r, False) for c, rs in talks.items() for r in rs],
                                 "conv_id long, turn long, role string, text string, gone boolean")
    got = {r[0]: tuple(r)[1:] for r in R.repair(rows.repartition(3)).collect()}
    assert got == want


def damaged(rows):
    """The contract's damage, by hand."""
    out, ids = {}, []
    for conv, turn, role, text in rows:
        ids.append(conv)
        role, text = (" " if x is None else x for x in (role, text))
        show = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    return out


def reports(talks):
    return {conv: by_loop(sorted_rows(rows))[1].row()[1:] for conv, rows in talks.items()}


def test_conversations_equal_plain_loop(spark, small):
    turns = documents(spark, small, "conversations")
    want = reports(damaged([(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()]))
    frame = R.repair_conversations(turns)
    assert {r[0]: tuple(r)[1:] for r in frame.collect()} == want
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_edges(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, None, "user", "Hi."), (1, None, "assistant", None), (1, 2, None, "What?"),
            (2, 1, "user", LONG), (2, 2, "assistant", LONG + "."), (2, 2, "assistant", LONG + "."), (3, 5, "", ""), (4, 1, "système", "Ä!"), (4, 9, "user", "ß?")]
    rows += [(at, 1, "user", "Hi.") for at in range(100, 140)]
    want = reports(damaged(rows))
    empty = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", empty) in want.values()
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, gone string, at int")
    assert {r[0]: tuple(r)[1:] for r in R.repair_conversations(turns).collect()} == want
    assert R.repair_conversations(turns.where("false")).count() == 0
