"""Repair of conversations against a table of cheapest audits over every prefix, and its defined cases."""

import hashlib
import random
import zlib

import pytest

from mercato.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, cost int, codes string"
SPACE = " \t\n\x0b\x0c\r"
MOVES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
ROLES = {"u": "user", "a": "assistant"}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        lot = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else text.translate({ord(c): None for c in ".!?"}) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def inserts(best):
    """Relax inserted rows until nothing gets better; an entry is (cost, audit, lines) by state."""
    changed = True
    while changed:
        changed = False
        for state, (cost, audit, lines) in list(best.items()):
            for i, role in ROLES.items():
                if (state, i) in MOVES:
                    new = (cost + 3, audit + "I", lines + (f"{role}:",))
                    if new[:2] < best.get(MOVES[state, i], (9e9,))[:2]:
                        best[MOVES[state, i]], changed = new, True
    return best


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        kinds.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen
                     else "truncated" if text.strip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    best = inserts({"": (0, "", ())})
    for (_, _, role, text), kind in zip(rows, kinds):
        new = {}

        def offer(state, cost, audit, lines):
            if (cost, audit) < new.get(state, (9e9,))[:2]:
                new[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 4, audit + "D", lines)
            if kind in ("", "truncated"):
                more = 3 * (kind == "truncated")
                if (state, role[:1]) in MOVES:
                    offer(MOVES[state, role[:1]], cost + more, audit + "K", lines + (f"{role}:{text}",))
                for i, name in ROLES.items():
                    if (state, i) in MOVES:
                        offer(MOVES[state, i], cost + 3 + more, audit + "R", lines + (f"{name}:{text}",))
        best = inserts(new)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
            kinds.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def compare(spark, rows, damaged_, segment=C.SEGMENT):
    ids = spark.createDataFrame([(r[0],) for r in rows] or [], "conv_id long")
    got = C.digests(frame(spark, damaged_), ids, segment=segment).collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    by = {r["conv_id"]: tuple(r[n] for n in names) for r in got}
    assert len(got) == len(by) == len({r[0] for r in rows})
    for conv in by:
        assert by[conv] == brute([tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in damaged_ if r[0] == conv]), conv
    return by


def talk(r, conv, n):
    said = ["Yes.", "yes", "", " \t", "Why?", "Well", "No!", "a b c.", "x\ny", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"]
    return [(conv, r.choice([t, t, t, t, None, t + 3]), r.choice(roles[:4] if r.random() < 0.6 else roles),
             f"Line {t}, {r.random()}." if r.random() < 0.6 else r.choice(said)) for t in range(n)]


@pytest.mark.parametrize("segment", [C.SEGMENT, 3])
def test_against_table_of_audits(spark, segment):
    r = random.Random(segment)
    rows = [row for c in range(60) for row in talk(r, c, r.randint(0, 12))] + talk(r, None, 9) + talk(r, 99, 150)
    compare(spark, rows, rows, segment)


def test_damage_and_lost_conversations(spark):
    r = random.Random(5)
    rows = [row for c in range(80) for row in talk(r, c, r.choice([1, 2, 6]))]
    got = C.damaged(frame(spark, rows)).collect()
    assert sorted(map(repr, (tuple(x) for x in got))) == sorted(map(repr, damage(rows)))
    by = compare(spark, rows, damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert sum(v == empty for v in by.values()) > 0


def test_copies_and_empty_table(spark):
    rows = [(1, 0, "user", "Hello.")] * 40 + [(1, 1, "assistant", "Hi.")] + [(1, 2, "user", "Hello.")] * 3
    assert compare(spark, rows, rows)[1][6] == "K" + "D" * 39 + "KDDD"
    assert compare(spark, [], []) == {}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So?"), (1, 2, "assistant", "Yes."), (2, 0, "tool", "x."), (2, None, "system", "Be kind.")]
    got = sorted(tuple(x) for x in C.repaired(frame(spark, rows)).collect() if x["conv_id"] == 1)
    assert got == [(1, 0, "I", None, "user", ""), (1, 1, "K", 0, "assistant", "Hi."), (1, 2, "K", 1, "user", "So?"),
                   (1, 3, "K", 2, "assistant", "Yes.")]
    got = sorted(tuple(x) for x in C.repaired(frame(spark, rows), segment=1).collect() if x["conv_id"] == 2)
    assert got == [(2, 0, "K", None, "system", "Be kind."), (2, 1, "I", None, "user", ""), (2, 2, "R", 0, "assistant", "x.")]


def test_prices_satisfy_complementary_slackness():
    r = random.Random(1)
    for _ in range(50):
        codes = "".join(r.choice("dusaoUSAO") for _ in range(r.randint(0, 40)))
        arcs = C.lattice(codes, C.END)
        price = C.auction(arcs, range(4))
        assert all(price[i] <= a[1] + price[a[2]] for i, out in enumerate(arcs) for a in out)
        far = [float("inf")] * (len(arcs) - 1) + [0.0]
        for _ in range(4 * len(arcs)):
            for i in range(len(arcs) - 2, -1, -1):
                far[i] = min([far[i]] + [a[1] + far[a[2]] for a in arcs[i]])
            if all(far[i] <= a[1] + far[a[2]] for i, out in enumerate(arcs) for a in out):
                break
        assert price[:4] == far[:4]
        assert C.prices(codes, C.END, block=5)[0] == far[:4]
