import hashlib
import itertools
import random
import zlib

import numpy as np

from yearloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\f\r"


def shown(value):
    return " " if value is None else str(value)


def hurt(rows):
    """{conv_id: [(turn, role, text)]} after damage, in order."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: in_order(own) for c, own in found.items()}


def in_order(own):
    digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))


def faults(own):
    seen, found = set(), []
    for _, role, text in own:
        end = text.rstrip(SPACES)
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(own):
    """Least (cost, audit, lines) by a plain forward search over all states."""
    after = {"s": "u", "u": "a", "a": "u", "": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        for _ in range(3):
            for last, (cost, audit, lines) in list(best.items()):
                to = after[last]
                new = (cost + 5, audit + "I", [*lines, names[to] + ":"])
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    best = with_inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(own, faults(own), strict=True):
        new = {}

        def offer(last, entry, new=new):
            if last not in new or entry < new[last]:
                new[last] = entry

        for last, (cost, audit, lines) in best.items():
            offer(last, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            if role[:1] == after[last] or (role[:1] == "s" and last == ""):
                offer(role[:1], (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
            offer(after[last], (cost + extra + 1, audit + "R", [*lines, f"{names[after[last]]}:{text}"]))
        best = with_inserts(new)
    return min(best[last] for last in ("", "a") if last in best)


def brute(rows):
    found = []
    for conv, own in hurt(rows).items():
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        kinds = faults(own)
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        cost, audit, lines = cheapest(own)
        found.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                      sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(found, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "ua"]
    texts = ["Fine.", "Yes!", "cut off", " \t", None, "", "Is it?  \n", "end. x", "Häß.", "no", "."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(most)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles[:rng.choice([2, 3, 10])]),
                         rng.choice(texts[:rng.choice([3, 11])]) if rng.random() < 0.5 else f"Say {rng.randrange(40)}{rng.choice('.!? ')}"))
    return rows


def test_agrees_with_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS_TOGETHER", 40)
    rows = random_rows(1, 300, 14)
    want = brute(rows)
    assert got(repair.damage_and_repair(spark.createDataFrame(rows, SCHEMA))) == want
    assert len({w[7] for w in want}) > 100 and any("R" in w[7] for w in want)


def test_inserts_where_deleting_costs_more(spark, monkeypatch):
    monkeypatch.setattr(repair, "DELETE", 20)
    monkeypatch.setattr(repair, "REROLE", 12)
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "system", "C."), (1, 3, "assistant", "D.")]
    messages = repair.messages(spark.createDataFrame(rows, SCHEMA))
    reports = repair.report(messages)
    assert reports.first().audit == "KIKIRK" and reports.first().cost == 22
    lines = repair.repaired(messages, reports).orderBy("place").collect()
    assert [(r.role, r.text) for r in lines] == [("user", "A."), ("assistant", ""), ("user", "B."), ("assistant", ""),
                                                 ("user", "C."), ("assistant", "D.")]


def test_long_conversation_and_its_messages(spark):
    rows = [(1, i, ("user", "assistant", "tool")[i * i % 3], f"Text {i}.") for i in range(3_000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    reports = got(repair.damage_and_repair(df))
    assert reports == brute(rows)
    damaged = repair.damaged(df)
    lines = repair.repaired(damaged, repair.report(damaged)).where("conv_id = 1").orderBy("place").collect()
    assert [r.place for r in lines] == list(range(len(lines)))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest() == reports[0][-1]
    assert {r.edit for r in lines} == {"K", "R"}


def test_undamaged_rows_are_read_as_they_are(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 0, "user", "Hi.")]
    reports = repair.report(repair.messages(spark.createDataFrame(rows, SCHEMA)))
    assert got(reports.select("conv_id", "cost", "audit")) == [(1, 0, "KKK"), (2, 2, "D")]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 2, "user", "A."), (None, 3, "assistant", "B" * 50_000 + "."),
            (5, -(2**63), "user", "x."), (5, 2**63 - 1, "assistant", "y."), (7, None, "user", "q?")]
    rows += [(9, t, "user", "Same.") for t in range(400)] + [(11, 1, "user", "Twice.")] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    want = [(*w[:1], min(w[1], 2**63 - 1), *w[2:]) for w in brute(rows)]
    assert got(repair.damage_and_repair(df)) == want
    assert got(repair.damage_and_repair(df.selectExpr("*", "1 as copies", "2 as kind", "3 as audit", "4 as same"))) == want
    assert repair.damage_and_repair(df.limit(0)).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = repair.damage_and_repair(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(only) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_batches_are_cut_between_conversations():
    import pyarrow as pa
    ids = [None, None, 1, 1, 1, 1, 1, 1, 2, 3, 3]
    batches = [pa.record_batch({"conv_id": pa.array(ids[i:i + 2], pa.int64())}) for i in range(0, len(ids), 2)]
    old, repair.ROWS_TOGETHER = repair.ROWS_TOGETHER, 3
    try:
        tables = [t.column("conv_id").to_pylist() for t in repair.whole_conversations(iter(batches))]
    finally:
        repair.ROWS_TOGETHER = old
    assert sum(tables, []) == ids
    assert all(len([t for t in tables if i in t]) == 1 for i in set(ids))


def test_ranks_pick_the_least_audit_of_equal_cost():
    """All audits of short conversations, one by one, against the ranked paths."""
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 6))
        initial, must, cut = rng.integers(0, 4, n), rng.random(n) < 0.2, rng.random(n) < 0.3
        cost, letters, bounds = repair.audits(np.array([0, n]), initial, must, cut & ~must)
        own = [(0, "?sua"[c], f"{i}" + ("" if d else ".")) for i, (c, d) in enumerate(zip(initial, cut, strict=True))]
        own = [(t, r, "" if m else x) for (t, r, x), m in zip(own, must, strict=True)]
        want = cheapest(own)
        assert (cost[0], letters[bounds[0]:bounds[1]].tobytes().decode()) == want[:2]
