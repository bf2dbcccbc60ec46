"""Conversation repair against plain walks over all rows and states."""

import hashlib
import itertools
import random
import zlib

import pytest

from check import compare
from txnlake.llm import queries, repair

DUE = {"": "u", "s": "u", "u": "a", "a": "u"}


def inserted(best):
    """Least (cost, letters, lines) by state, with empty turns added behind."""
    for _ in range(3):
        for state, (cost, audit, lines) in list(best.items()):
            to = DUE[state]
            name = "user" if to == "u" else "assistant"
            found = (cost + 5, audit + "I", [*lines, f"{name}:"])
            if to not in best or found[:2] < best[to][:2]:
                best[to] = found
    return best


def brute(rows):
    """Least (cost, letters, lines) of rows (role, text, fault)."""
    best = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}

        def put(state, found, after=after):
            if state not in after or found[:2] < after[state][:2]:
                after[state] = found

        for state, (cost, audit, lines) in inserted(dict(best)).items():
            put(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            late, initial = 5 * (fault == "truncated"), role[:1]
            if initial == DUE[state] or initial == "s" and state == "":
                put(initial, (cost + late, audit + "K", [*lines, f"{role}:{text}"]))
            name = "user" if DUE[state] == "u" else "assistant"
            put(DUE[state], (cost + 1 + late, audit + "R", [*lines, f"{name}:{text}"]))
        best = after
    ends = inserted(dict(best))
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda e: e[:2])


def of_symbols(symbols):
    names = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}
    faults = {True: "truncated", False: ""}
    return [
        (names[c.lower()], str(i), "blank" if c == "x" else faults[c.isupper()]) for i, c in enumerate(symbols)
    ]


def draws():
    rng = random.Random(1)
    yield from map("".join, itertools.chain(*(itertools.product(repair.SYMBOLS, repeat=n) for n in range(4))))
    for _ in range(800):
        yield "".join(rng.choice(rng.choice(["suaSUAox", "ua", "sx", "uUaA"])) for _ in range(rng.randrange(4, 40)))


def test_edits_are_the_cheapest_and_least():
    for symbols in draws():
        audit = repair.edits(symbols)
        cost, want, _ = brute(of_symbols(symbols))
        assert (repair.edit_cost(symbols, audit), audit) == (cost, want), symbols


def test_vectors_over_chunks_equal_vectors_over_rows():
    rng = random.Random(2)
    for _ in range(300):
        symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(rng.randrange(2, 30)))
        cut = rng.randrange(1, len(symbols))
        chunks = []
        for part in (symbols[:cut], symbols[cut:]):
            chunk = repair._Chunk()
            chunk.symbols = list(part)
            chunks.append(chunk.row(1, 0, 0, whole=False)["costs"])
        start = ([0, repair._NONE, repair._NONE, repair._NONE], [0] * 4)
        costs, ranks = repair.over_chunk(*repair.over_chunk(*start, chunks[0]), chunks[1])
        want_costs, want_ranks = repair.forward(symbols, *start)
        assert costs == want_costs
        reached = [s for s in range(4) if costs[s] < repair._NONE]
        assert sorted(reached, key=ranks.__getitem__) == sorted(reached, key=want_ranks.__getitem__)
        end = repair.end_costs(None)
        assert repair.before_chunk(end, chunks[0]) == repair.backward(symbols[:cut], end)


def digest(rows):
    """The contract, row by row: rows (conv_id, turn, role, text), damaged already."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            [(t is not None, t or 0, r or " ", " " if x is None else x, t) for c, t, r, x in rows if c == conv],
            key=lambda r: r[:4],
        )
        seen, faulty = set(), []
        for *_, role, text, _turn in own:
            said = text.rstrip(repair.BLANKS)
            fault = (
                "blank" if not said
                else "duplicate" if (role, text) in seen
                else "truncated" if said[-1] not in ".!?"
                else ""
            )
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [r[4] for r in own if r[4] is not None]
        initials = [role[:1] for role, *_ in faulty]
        cost, audit, lines = brute(faulty)
        count = lambda name: sum(f == name for *_, f in faulty)  # noqa: B023, E731
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.select("conv_id", *names).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 2, "user", "a."), (None, 2, "user", "a."), (5, None, "tool", "x!")]
    rows += [(6, 1, "", ""), (6, 1, "assistant", " \t\n"), (7, 0, "system", "only."), (8, 3, "user", "é" * 5000)]
    texts = ["one.", "two", "three! ", "", " ", "four?\n", "five.x", "一。", "six."]
    roles = ["user", "assistant", "system", "tool", "user", "assistant"]
    for conv in range(10, 40):
        for i in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([i, i, i + 2, None]), rng.choice(roles), rng.choice(texts) + str(i % 3) * (i % 2)))
    # One conversation of most rows, with a row said very often and one text at many turns.
    rows += [(99, i // 2, rng.choice(roles), f"{rng.choice(texts)}{i // 4}.") for i in range(400)]
    rows += [(99, 40, "user", "again.")] * 150 + [(99, i, "user", "again.") for i in range(0, 200, 3)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, part int, digest string, copies int"


@pytest.mark.parametrize("chunk", [(3, 1 << 20), (4096, 40), (4096, 1 << 20)])
def test_conversations(spark, odd_rows, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk[0])
    monkeypatch.setattr(repair, "CHUNK_CHARS", chunk[1])
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in odd_rows], SCHEMA)
    assert collected(repair.repair_conversations(df)) == digest(odd_rows)


def test_empty_table_and_conversations_without_rows(spark, odd_rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in odd_rows], SCHEMA)
    none = repair.repair_conversations(df.limit(0))
    assert none.count() == 0
    got = collected(repair.with_unsaid(none, df))
    assert set(got) == {r[0] for r in odd_rows}
    assert set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_damage(spark, odd_rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in odd_rows], SCHEMA)
    want = []
    for conv, turn, role, text in odd_rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if draw == 2 else text
        want += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    got = [tuple(r) for r in queries.damaged(df.select("conv_id", "turn", "role", "text")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_equals_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op11_conversation_repair"
    ok, note = compare(queries.QUERIES[name](spark, sf), sf, queries.ORACLE_SQL[name])
    assert ok, note
