"""Conversation structure repair over a suffix-shared automaton (DAWG).

A row of a conversation is blank (nothing but ASCII white space), a duplicate (its
role and text stood earlier in the conversation), truncated (its last character that
is no white space does not end a sentence) or sound; its first fault counts.  Edits
keep a row, change its role to user or assistant, delete it, or insert an empty row,
so that the initials of the roles read ``(s?(ua)+)?``; the cheapest edits are wanted,
of equally cheap ones those whose initials (K, R, D, I) come first.

What edits cost depends on a row's signature alone: its initial and fault, one of nine
letters.  A conversation's signature is their word.  The distinct signatures of all
conversations, read from the end, form an automaton in which conversations that end
alike share their nodes.  Signatures are sorted by their reversed words, so a task
meets them in the automaton's order and holds one path of it: a node is made when its
letter is first read, and its costs to go with the best audits are computed then, once
for all conversations, for every grammar state at the node and at the end.

Long conversations: rows are numbered by a range partition of all rows, so a
conversation with a third of all rows is dealt to many tasks, and cut into pieces of
``PIECE`` rows, each with a signature of its own.  A pass from the last piece to the
first sums the costs to go (four numbers a conversation), one from the first to the
last follows the best states and writes the repaired rows into the digest.  Both read
a conversation's pieces one after the other and hold one; the digest of one text has to
be read in order, so that is one task a conversation, of bounded memory but for the
audit itself.  That audits of pieces can be compared piece by piece rests on this: two
audits of equal cost over the same rows that lead to the same state are never one the
beginning of the other, as the longer would only add inserts.

Defined results: a null id is a conversation of its own; null roles and texts are one
space; null turns come first, rows of a turn are ordered by role, then by the first 64
characters of the text, then by its digest; repeated
rows are duplicates; a role without characters has no initial and cannot be kept; an
empty conversation has no cost and the digest of the empty text; very long texts are
read whole; columns beside the four are not read, so their names cannot clash; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import bound_batches, cut_lineage
from shelfwise.operators.ordering import global_index

ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: Grammar states: nothing yet, after s, after u, after a; what may follow, and where it leads.
STATES = range(4)
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
#: The one role that a new or changed row may have in a state.
NEW_ROLE = ("u", "u", "a", "u")
#: Rows of a piece.
PIECE = 512
#: Letters of a signature: s, u, a, x (any other initial), upper case if truncated, d if the row must go.
MUST_GO = "d"
LEGAL_PAIRS = ("su", "ua", "au")
#: Cost beyond any audit: there is none.
NEVER = (1 << 60, "")

Costs = tuple[tuple[tuple[int, str], ...], ...]


def _inserts() -> Costs:
    """Cheapest inserts from each state to each state."""
    table = [[NEVER] * 4 for _ in STATES]
    for s in STATES:
        at, cost, audit = s, 0, ""
        while table[s][at] == NEVER:
            table[s][at] = (cost, audit)
            at, cost, audit = FOLLOWS[at][NEW_ROLE[at]], cost + COST[INSERT], audit + INSERT
    return tuple(tuple(row) for row in table)


#: Costs to go at the end of a signature: [state][state at the end] -> (cost, audit).
END: Costs = _inserts()


def extended(letter: str, below: Costs) -> Costs:
    """The costs to go of a node from those of the node that its letter leads to."""
    fault = TRUNCATED_COST if letter.isupper() else 0
    # the row itself is edited in some state; inserts lead there
    edited = []
    for s in STATES:
        ways = [(COST[DELETE], DELETE, s)]
        if letter != MUST_GO:
            ways.append((COST[REROLE] + fault, REROLE, FOLLOWS[s][NEW_ROLE[s]]))
            if letter.lower() in FOLLOWS[s]:
                ways.append((COST[KEEP] + fault, KEEP, FOLLOWS[s][letter.lower()]))
        edited.append([min((c + below[to][t][0], e + below[to][t][1]) for c, e, to in ways) for t in STATES])
    return tuple(tuple(min((END[s][m][0] + edited[m][t][0], END[s][m][1] + edited[m][t][1]) for m in STATES if END[s][m] != NEVER)
                       for t in STATES) for s in STATES)


def _automaton(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of signatures that come in the order of their reversed words."""
    read, path = "", [END]
    for batch in batches:
        out = []
        for signature in batch.column(0).to_pylist():
            word = signature[::-1]
            shared = next((i for i, (x, y) in enumerate(zip(word, read)) if x != y), min(len(word), len(read)))
            del path[shared + 1:]
            for letter in word[shared:]:
                path.append(extended(letter, path[-1]))
            read = word
            out.append([path[-1][s][t] for s, t in product(STATES, STATES)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[c for c, _ in row] for row in out], pa.list_(pa.int64())),
                                          pa.array([[a for _, a in row] for row in out], pa.list_(pa.string()))],
                                         names=["signature", "costs", "audits"])


def signature_costs(signatures: DataFrame) -> DataFrame:
    """``signature, costs, audits`` of distinct signatures: for each state before
    and, within it, each state after, the least cost and its first audit."""
    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    word = F.reverse("signature")
    ranged = signatures.select("signature").distinct().repartitionByRange(n, word).sortWithinPartitions(word)
    return ranged.mapInArrow(_automaton, "signature string, costs array<long>, audits array<string>")


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with a fault put into one row in four, by a
    hash of the row's conversation and turn."""
    or_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col)), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(or_space(text_col), "[.!?]", "")).otherwise(or_space(text_col))
    hit = rows.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                      F.when(kind == 4, "user").otherwise(or_space(role_col)).alias("role"), text.alias("text"), kind.alias("_kind"))
    hit = hit.where("_kind <> 0")
    return hit.withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
                          ).drop("_kind", "_copy")


def _rows(rows: DataFrame) -> DataFrame:
    """Every row with its conversation's key ``c``, fault, letter and place."""
    none = F.col("conv_id").isNull()
    keyed = rows.select(F.when(none, F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string"))).alias("c"), "turn",
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # rows alike are counted before they travel on; but the first, they are duplicates
    alike = cut_lineage(keyed.groupBy("c", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
                        .withColumn("body", F.md5("text")))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    earliest = alike.groupBy(F.col("c").alias("_c"), F.col("role").alias("_role"), F.col("body").alias("_body")).agg(F.min(when).alias("_first"))
    met = alike.join(earliest, (F.col("c") == F.col("_c")) & (F.col("role") == F.col("_role")) & (F.col("body") == F.col("_body")))
    each = met.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    again = (F.col("copy") > 1) | ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    text = F.col("text")
    fault = F.when(_blank(text), "blank").when(again, "duplicate").when(_truncated(text), "truncated")
    each = each.withColumn("fault", fault)
    gone = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(gone, MUST_GO).when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    order = F.when(~gone, text)  # what is deleted in any case travels without its text
    each = each.select("c", "turn", "role", order.alias("text"), "body", "copy", "fault", initial.alias("initial"), letter.alias("letter"),
                       F.col("copies"), F.substring(text, 1, 64).alias("_head"))
    return global_index(each, [F.col(c) for c in ("c", "turn", "role", "_head", "body", "copy")], "place")


def pieces(rows: DataFrame) -> DataFrame:
    """``c, piece, signature, rows`` (role and text in order) of all conversations,
    and by piece the numbers of faults and of illegal neighbours, ``first`` and
    ``last`` initial."""
    placed = _rows(rows)
    starts = placed.groupBy("c").agg(F.min("place").alias("_start"))
    at = placed.join(starts, "c").withColumn("place", F.col("place") - F.col("_start"))
    entry = F.struct("place", "letter", "role", "text", "initial")
    count = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    got = at.groupBy("c", F.floor(F.col("place") / PIECE).cast("long").alias("piece")).agg(
        F.array_sort(F.collect_list(entry)).alias("rows"), count("blank"), count("duplicate"), count("truncated"))
    joined = F.array_join(F.transform("rows", lambda r: r["letter"]), "")
    pairs = F.zip_with(F.slice("rows", F.lit(1), F.size("rows") - 1), F.slice("rows", F.lit(2), F.size("rows") - 1),
                       lambda x, y: F.concat(x["initial"], y["initial"]))
    return got.select("c", "piece", joined.alias("signature"), F.transform("rows", lambda r: F.struct(r["role"], r["text"])).alias("rows"),
                      "blank", "duplicate", "truncated", F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL_PAIRS))).cast("long").alias("illegal"),
                      F.col("rows")[0]["initial"].alias("first"), F.element_at("rows", -1)["initial"].alias("last"))


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state after each piece, by the state before it, on a cheapest way to the
    end; pieces come from the last to the first of a conversation."""
    conv, to_go = None, None
    for batch in batches:
        after = []
        for c, costs, audits in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if c != conv:
                conv, to_go = c, [0 if s in ACCEPTED else NEVER[0] for s in STATES]
            best = [min((costs[4 * s + t] + to_go[t], audits[4 * s + t], t) for t in STATES) for s in STATES]
            to_go = [b[0] for b in best]
            after.append([b[2] for b in best])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(after, pa.list_(pa.int32()))], names=["c", "piece", "after"])


def _lines(rows: list[dict], state: int, audit: str) -> Iterator[str]:
    """The repaired rows of a piece."""
    left = iter(rows)
    for edit in audit:
        row = None if edit == INSERT else next(left)
        if edit == DELETE:
            continue
        initial = row["role"][:1] if edit == KEEP else NEW_ROLE[state]
        role, text = row["role"] if edit == KEEP else ROLES[initial], "" if edit == INSERT else row["text"]
        state = FOLLOWS[state][initial]
        yield f"{role}:{text}"


SUMS = ("cost", "blank", "duplicate", "truncated", "illegal")
REPAIRED = "c string, " + ", ".join(f"{x} long" for x in SUMS) + ", audit string, repaired_sha256 string"


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired conversations from their pieces, first to last."""
    conv, state, sums, audit, digest, last, lines = None, 0, {}, [], None, "", 0

    def whole() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"c": conv, **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema=kind)

    kind = pa.schema([("c", pa.string()), *[(x, pa.int64()) for x in SUMS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for batch in batches:
        for i in range(batch.num_rows):
            p = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            if digest is None or p["c"] != conv:
                if digest is not None:
                    yield whole()
                conv, state, sums, audit, digest, lines = p["c"], 0, dict.fromkeys(SUMS, 0), [], hashlib.sha256(), 0
            elif last + p["first"] not in LEGAL_PAIRS:
                sums["illegal"] += 1
            last, to = p["last"], p["after"][state]
            edits = p["audits"][4 * state + to]
            sums["cost"] += p["costs"][4 * state + to]
            for x in SUMS[1:]:
                sums[x] += p[x]
            for line in _lines(p["rows"], state, edits):
                digest.update((("\n" if lines else "") + line).encode("utf-8", "surrogatepass"))
                lines += 1
            audit.append(edits)
            state = to
    if digest is not None:
        yield whole()


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of every conversation of ``rows`` (conv_id, turn, role, text)."""
    bound_batches(rows.sparkSession)
    # the rows go on from a written table: the branches below share it
    parts = cut_lineage(pieces(rows))
    costs = cut_lineage(signature_costs(parts))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    priced = parts.select("c", "piece", "signature").join(costs, "signature")
    last_first = priced.select("c", "piece", "costs", "audits").repartition(n, "c").sortWithinPartitions("c", F.desc("piece"))
    after = last_first.mapInArrow(_backwards, "c string, piece long, after array<int>")
    ready = parts.join(costs, "signature").join(after, ["c", "piece"]).drop("signature")
    done = ready.repartition(n, "c").sortWithinPartitions("c", "piece").mapInArrow(_forwards, REPAIRED)
    key = F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    turns = rows.groupBy("conv_id").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("n_turns"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    return turns.select("conv_id", key.alias("c"), gaps.alias("gaps")).join(done, "c").drop("c")


def repair_all(original: DataFrame, after_damage: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``repair`` of ``after_damage``, with a row for every conversation of
    ``original``; those without rows have nothing to repair."""
    every = original.select(F.col(f"`{conv_col}`").alias("_every")).distinct()
    found = repair(after_damage)
    met = every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select(F.col("_every").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
