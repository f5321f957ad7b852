"""Conversation repair against all edit sequences, in small, in long and in odd tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import conversations
from tidewell.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(SPACES)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters, repaired rows) over every way to insert up to two rows anywhere and edit each row."""
    found = faults(rows)
    inserts = [s for n in range(3) for s in itertools.product(["user", "assistant"], repeat=n)]
    slots = []
    for (_, role, text), fault in zip(rows, found, strict=True):
        edits = [("D", 4, [])]
        if fault in ("", "truncated"):
            extra = 3 * (fault == "truncated")
            edits += [("K", extra, [(role, text)])]
            edits += [("R", 3 + extra, [(r, text)]) for r in ("user", "assistant")]
        slots.append([("I" * len(s) + e, 3 * len(s) + c, [(r, "") for r in s] + left)
                      for s in inserts for e, c, left in edits])
    slots.append([("I" * len(s), 3 * len(s), [(r, "") for r in s]) for s in inserts])
    best = None
    for way in itertools.product(*slots):
        cost = sum(c for _, c, _ in way)
        if best is not None and cost > best[0]:
            continue
        left = [row for _, _, part in way for row in part]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)):
            best = min(best or (999, "", []), (cost, "".join(e for e, _, _ in way), left))
    return best


def plain(rows):
    """The digest columns of one conversation of sorted (turn, role, text)."""
    found = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = zip(rows, rows[1:], strict=False)
    cost, audit, left = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(found.count(kind) for kind in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    )


def by_turn(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "unknown"]
    texts = ["Yes.", "No!", "cut", "", " \n", "Why?  ", "and so"]
    return by_turn(
        (rng.choice([None, 0, 1, 2, 5, 9]), rng.choices(roles, [5, 5, 2, 1, 1, 1])[0], rng.choice(texts))
        for _ in range(n)
    )


@pytest.mark.parametrize("seed", range(40))
def test_equals_all_edit_sequences(seed):
    rng = random.Random(seed)
    rows = some_rows(rng, seed % 4)
    repair = conversations.Repair()
    for row in rows:
        repair.add(*row)
    steps = list(repair.repaired())
    left = "\n".join(f"{r}:{t.decode()}" for e, r, t in steps if e != "D")
    got = (repair.gaps(), repair.blank, repair.duplicate, repair.truncated, repair.illegal, repair.cost,
           "".join(e for e, _, _ in steps), hashlib.sha256(left.encode()).hexdigest())
    assert got == plain(rows)


def test_spilled_conversation_is_the_same(monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(900)}.") for i in range(3000)]

    def outcome():
        repair = conversations.Repair()
        for row in rows:
            repair.add(*row)
        return repair.cost, repair.duplicate, list(repair.repaired())

    want = outcome()
    monkeypatch.setattr(conversations, "SPILL_BYTES", 100)
    monkeypatch.setattr(conversations, "SEEN_AT_ONCE", 50)
    monkeypatch.setattr(conversations, "ROWS_BACK", 7)
    assert outcome() == want
    assert want[1] == 3000 - len({(r, t) for _, r, t in rows})


def test_repairs_equal_plain(spark):
    rng = random.Random(1)
    convs = {c: some_rows(rng, rng.randrange(4)) for c in [None, *range(60)]}
    data = [(c, *row) for c, rows in convs.items() for row in rows]
    rng.shuffle(data)
    got = {r[0]: tuple(r)[1:] for r in conversations.repairs(spark.createDataFrame(data, ROWS)).collect()}
    assert got == {c: plain(rows) for c, rows in convs.items() if rows}


def test_turns_are_those_of_the_hash(spark):
    rng = random.Random(2)
    data = [(c, *row) for c in range(30) for row in some_rows(rng, 5)]
    frame = spark.createDataFrame(data, ROWS)
    turns = {}
    for r in conversations.repaired_turns(frame).orderBy("conv_id", "place").collect():
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversations.repairs(frame).collect():
        text = "\n".join(turns.get(r.conv_id, []))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            out += [(turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    return by_turn(out)


def test_query_equals_plain(spark):
    """Every conversation of the table, by a plain search over states instead of all sequences."""
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversations"](spark, folder).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        after = damage([r for r in rows if r[0] == conv])
        if len(after) <= 3:
            assert got[conv] == plain(after), conv
        assert got[conv][1] == faults(after).count("blank")
        assert got[conv][2] == faults(after).count("duplicate")


def test_all_rows_dropped(spark, tmp_path):
    turn = next(t for t in range(999) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    data = [(7, turn, "user", "Gone.")]
    spark.createDataFrame(data, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = QUERIES["op13_conversations"](spark, str(tmp_path)).collect()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_odd_conversations(spark, tmp_path):
    empty = f"{tmp_path}/empty"
    spark.createDataFrame([], ROWS).write.parquet(f"{empty}/conversations.parquet")
    assert QUERIES["op13_conversations"](spark, empty).count() == 0
    data = [(None, None, None, None), (1, None, None, "Hm."), (1, 3, "user", "word " * 200_000 + "end."),
            (1, 3, "user", "word " * 200_000 + "end."), (2, 1, "assistant", None)]
    frame = spark.createDataFrame(data, ROWS).withColumns(
        {c: F.lit("x") for c in ("conv", "present", "at", "copy", "place", "edit")}
    )
    frame.write.parquet(f"{tmp_path}/odd/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversations"](spark, f"{tmp_path}/odd").collect()}
    want = {c: plain(damage([r for r in data if r[0] == c])) for c in (None, 1, 2)}
    assert got == want
