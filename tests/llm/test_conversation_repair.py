"""Conversation repair against a full chart over all spans and splits, and against a search over edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from orderflow.llm import conversation_repair as cr
from orderflow.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
GOAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows, limit=4):
    """Least (cost, audit, roles) by trying all edits; rows are (initial, must go, truncated)."""
    best = None
    choices = []
    for initial, must_go, broken in rows:
        options = [("D", None, 4)]
        if not must_go:
            options += [("K", initial, 3 * broken), ("R", "u", 3 + 3 * broken), ("R", "a", 3 + 3 * broken)]
        choices.append(options)
    fillers = ["".join(f) for n in range(limit) for f in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(fillers, repeat=len(rows) + 1):
            roles = gaps[0] + "".join((r or "") + g for (_, r, _), g in zip(edits, gaps[1:]))
            if GOAL.match(roles):
                audit = "I" * len(gaps[0]) + "".join(e + "I" * len(g) for (e, _, _), g in zip(edits, gaps[1:]))
                found = (sum(c for _, _, c in edits) + 3 * sum(map(len, gaps)), audit, roles)
                best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("seed", range(25))
def test_edits_against_a_search(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("suax"), rng.random() < 0.25, rng.random() < 0.3) for _ in range(seed % 4)]
    spans = [dict(cr.row_cells(i if i in "sua" else "", g, b and not g)) for i, g, b in rows]
    assert cr.best(cr.parse(spans)) == cheapest(rows)[:2]


@pytest.mark.parametrize("n", [1, 2, 7, 16, 23])
def test_doubling_spans_against_all_splits(n):
    rng = random.Random(n)
    spans = [dict(cr.row_cells(rng.choice(["s", "u", "a", ""]), rng.random() < 0.2, rng.random() < 0.2)) for _ in range(n)]
    chart = {(i, i + 1): spans[i] for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: dict = {}
            for split in range(i + 1, i + length):
                found = cr.combine(chart[i, split], chart[split, i + length])
                cell = {k: min(cell.get(k, found[k]), found[k]) for k in found}
                assert cell == found
            chart[i, i + length] = cell
    assert cr.parse(spans) == chart[0, n]


def damage(rows):
    """{conv_id: damaged (turn, role, text) rows in order}."""
    out: dict = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        n = zlib.crc32(key.encode()) % 20
        if n:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(n, text)
            own += [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def step(state, role):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, role))


def by_states(leaves):
    """Least (cost, audit, rows) left to right over states; an independent way to the same answer."""
    best = {"": (0, "", ())}

    def insert(found):
        for state in ("", "s", "a", "u", "a"):
            if state in found:
                for role, name in (("u", "user"), ("a", "assistant")):
                    to = step(state, role)
                    if to:
                        cost, audit, rows = found[state]
                        new = (cost + 3, audit + "I", rows + (f"{name}:",))
                        found[to] = min(found.get(to, new), new)
        return found

    for role, text, must_go, broken in leaves:
        best, after = insert(best), {}
        for state, (cost, audit, rows) in best.items():
            options = [(state, (cost + 4, audit + "D", rows))]
            if not must_go:
                extra = 3 * broken
                if step(state, role[:1]):
                    options.append((step(state, role[:1]), (cost + extra, audit + "K", rows + (f"{role}:{text}",))))
                for name in ("user", "assistant"):
                    if step(state, name[0]):
                        options.append((step(state, name[0]), (cost + 3 + extra, audit + "R", rows + (f"{name}:{text}",))))
            for to, new in options:
                after[to] = min(after.get(to, new), new)
        best = after
    best = insert(best)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    out = []
    for conv, own in damage(rows).items():
        counts, seen, leaves = [0, 0, 0], set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            blank, again = not bare, (role, text) in seen
            broken = not blank and not again and bare[-1] not in ".!?"
            counts = [a + b for a, b in zip(counts, (blank, again and not blank, broken))]
            seen.add((role, text))
            leaves.append((role, text, blank or again, broken))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, left = by_states(leaves)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def made():
    rng = random.Random(5)
    texts = ["Hello.", "hello", "", "  \n", None, "What? ", "No end", "Done!\t", "été.", "x" * 3000 + ".", "Hello."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    rows = []
    for conv in [*range(60), None]:
        for n in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([n, n, n, 2 * n, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(77, n, "user" if n % 2 else "assistant", f"Turn {n % 900}.") for n in range(3000)]
    rows += [(78, 4, "user", "Same.")] * 5
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "Gone.")]


def test_conversations(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumn("cells", F.lit("clash")).withColumn("piece", F.lit(1))
    got = sorted(map(tuple, cr.repairs(cr.damaged(df)).collect()), key=str)
    assert got == expected(rows)
    left: dict = {}
    for r in cr.repaired_rows(cr.damaged(df)).collect():
        left.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    for conv, *_, digest in got:
        own = sorted(left.get(conv, []))
        assert [p for p, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(t for _, t in own).encode()).hexdigest() == digest
    assert cr.repairs(df.where("false")).count() == 0


def test_query_on_the_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, LLM_QUERIES["op13_conversation_repair"](spark, SF_DIR).collect()), key=str) == expected(rows)
