import hashlib
import random
import re
import zlib
from itertools import product

from shelfwise.llm import conversations as cv

KIND = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ends = text.strip(" \t\n\v\f\r")
        out.append("blank" if not ends else "duplicate" if (role, text) in seen else "truncated" if ends[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_audit(rows, found):
    """All audits with at most one insert before a row and two at the end, that read as the grammar wants."""
    best = None
    slots = [["", "I", "II"] for _ in range(len(rows) + 1)]
    edits = ["D" if f in ("blank", "duplicate") else "KRD" for f in found]
    for ins in product(*slots):
        for each in product(*edits):
            audit = "".join(i + e for i, e in zip(ins, each)) + ins[-1]
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + sum(3 for f, e in zip(found, each) if f == "truncated" and e != "D")
            if best and (cost, audit) >= best[:2]:
                continue
            left, initials, lines = iter(rows), "", []
            for e in audit:
                row = next(left) if e != "I" else None
                if e == "D":
                    continue
                new = "a" if initials[-1:] == "u" else "u"
                role = row[1] if e == "K" else {"u": "user", "a": "assistant"}[new]
                initials += role[:1]
                lines.append(f"{role}:{row[2] if row else ''}")
            if re.fullmatch("(s?(ua)+)?", initials):
                best = (cost, audit, "\n".join(lines))
    return best


def expected(conv, rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    found = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, text = every_audit(rows, found)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def result(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        for _ in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([0, 1, 2, 5, None]), rng.choice(["user", "assistant", "system", "tool", "user", "assistant", None]),
                         rng.choice(["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "ü.", "end.  "])))
    return rows


def test_equal_to_trying_every_audit(spark):
    rows = random_rows(5, 30, 4)
    convs = {r[0] for r in rows}
    want = sorted((expected(c, [r[1:] for r in rows if r[0] == c]) for c in convs), key=str)
    assert result(cv.repair(spark.createDataFrame(rows, KIND))) == want


def test_pieces_give_what_whole_conversations_give(spark, monkeypatch):
    rows = random_rows(6, 12, 40)
    whole = result(cv.repair(spark.createDataFrame(rows, KIND)))
    monkeypatch.setattr(cv, "PIECE", 3)
    assert result(cv.repair(spark.createDataFrame(rows, KIND))) == whole


def test_costs_of_a_node_do_not_depend_on_the_path_before():
    words = ["uau", "xau", "dau", "U", ""]
    from functools import reduce
    alone = {w: reduce(lambda below, letter: cv.extended(letter, below), reversed(w), cv.END) for w in words}
    import pyarrow as pa
    ordered = sorted(words, key=lambda w: w[::-1])
    (out,) = cv._automaton(iter([pa.RecordBatch.from_arrays([pa.array(ordered)], names=["signature"])]))
    for row in out.to_pylist():
        assert [tuple(x) for x in zip(row["costs"], row["audits"])] == [alone[row["signature"]][s][t] for s in range(4) for t in range(4)]


def test_damage_and_conversations_that_lose_all_rows(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    after = []
    for c, t, role, text in rows:
        c_, t_, role, text = (" " if x is None else x for x in (c, t, role, text))
        kind = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    damaged = cv.damaged(spark.createDataFrame(rows, KIND + "").selectExpr("*", "1 as kind", "2 as copy"))
    assert sorted(map(tuple, damaged.collect()), key=str) == sorted(after, key=str)
    lost = next(c for c in range(100_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hi."), (None, None, None, None)], KIND)
    got = result(cv.repair_all(df, cv.damaged(df)))
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got and len(got) == 2


def test_one_row_repeated_and_very_long_texts(spark):
    long = "word " * 300_000 + "end."
    rows = [(1, 0, "user", "Hi.")] * 2000 + [(1, 1, "assistant", long), (2, 3, "", "Empty role.")]
    got = {r[0]: r for r in result(cv.repair(spark.createDataFrame(rows, KIND)))}
    assert got[1][3] == 1999 and got[1][6] == 4 * 1999 and got[1][7] == "K" + "D" * 1999 + "K"
    assert got[1][8] == hashlib.sha256(f"user:Hi.\nassistant:{long}".encode()).hexdigest()
    assert got[2][6:8] == (4, "D")


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], KIND)
    assert result(cv.repair_all(empty, cv.damaged(empty))) == []
    clash = spark.createDataFrame([(1, 0, "user", "A.", 9, "z")], KIND + ", place int, c string")
    assert result(cv.repair(clash))[0][6:8] == (3, "KI")
