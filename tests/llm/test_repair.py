"""Conversation repair against an enumeration of all repairs, and a parse over all splits."""

import hashlib
import random
import re
import zlib

import pytest

from rollbook.llm import all_queries, repair

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        k = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def plain_repairs(rows):
    """The least (cost, audit, repaired rows) of (role, text, fault) rows: every audit that costs no
    more than deleting all is tried and its result is matched with the pattern."""
    most, found = 2 * len(rows), []

    def walk(i, cost, audit, out):
        if cost > most:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
            found.append((cost, audit, out))
        for role in ("user", "assistant"):
            walk(i, cost + 5, audit + "I", [*out, (role, "")])
        if i < len(rows):
            role, text, fault = rows[i]
            walk(i + 1, cost + 2, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                walk(i + 1, cost + more, audit + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    walk(i + 1, cost + 1 + more, audit + "R", [*out, (other, text)])

    walk(0, 0, "", [])
    return min(found)


def plain_report(rows):
    """Figures of one conversation after damage, rows (turn, role, text) in order."""
    seen, faulty, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else ""
        fault = fault or ("truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
        faulty.append((role, text, fault))
        if fault:
            counts[fault] += 1
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = plain_repairs(faulty) if rows else (0, "", [])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, digest)


def check(got, original, damaged):
    want = {}
    for conv in {r[0] for r in original}:
        rows = [r[1:] for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        want[conv] = plain_report(rows)
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = all_queries()["op11_conversation_repair"](spark, SF).collect()
    check(got, rows, plain_damage(rows))


SCHEMA = "conv_id long, turn long, role string, text string, block int, audit string, at string"


def test_edge_cases(spark):
    rnd = random.Random(11)
    texts = ["Yes.", "No", " \x0b", None, "", "Why? ", "end ", "é!", "x" * 3000 + ".", "one. two"]
    roles = ["user", "assistant", "system", "tool", "", None, "user"]
    rows = []
    for conv in [None, *range(120)]:
        turns = sorted(rnd.sample(range(12), rnd.randint(1, 6)))
        if rnd.random() < 0.2:
            turns[0] = None
        rows += [(conv, t, rnd.choice(roles), rnd.choice(texts)) for t in turns]
    rows += [(500, 3, "user", "Same."), (500, 3, "user", "Same."), (500, 4, "assistant", "Fine.")]
    rows += [(501, None, None, None)]
    turns = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    damaged = repair.damaged(turns)
    assert sorted(map(repr, map(tuple, damaged.collect()))) == sorted(map(repr, plain_damage(rows)))
    check(repair.report(turns, damaged).collect(), rows, plain_damage(rows))
    none = turns.limit(0)
    assert repair.report(none, repair.damaged(none)).count() == 0
    empty = repair.report(turns.where("conv_id = 501"), none.select("conv_id", "turn", "role", "text")).collect()
    assert tuple(empty[0])[1:7] == (0,) * 6 and empty[0].audit == ""


def test_blocks_make_no_difference(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant"]), f"{rnd.randint(0, 200)}{rnd.choice(['.', '!', ''])}")
            for c, n in ((1, 150), (2, 3), (3, 40)) for t in range(n)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, repair.report(turns, turns).collect()))
    monkeypatch.setattr(repair, "BLOCK_BITS", 2)
    monkeypatch.setattr(repair, "FOLD_BITS", 1)
    assert sorted(map(tuple, repair.report(turns, turns).collect())) == whole
    edited = repair.repaired(turns, repair.audits(repair.faults(turns))).collect()
    for conv in (1, 2, 3):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in edited if r.conv_id == conv))


@pytest.mark.parametrize("seed", range(40))
def test_every_split_gives_the_same_cell(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["s", "u", "a", "t", ""]), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(1, 9))]
    leaf = [repair.parse_rows([r]) for r in rows]
    cells = {(i, i + 1): leaf[i] for i in range(len(rows))}
    for size in range(2, len(rows) + 1):
        for i in range(len(rows) - size + 1):
            made = [repair.combine(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
            assert all(m == made[0] for m in made)
            cells[i, i + size] = made[0]
    assert cells[0, len(rows)] == repair.parse_rows(rows)
    assert repair.best(repair.EMPTY) == (0, "")
