"""Repair of role order in conversations: the cheapest edits, found run by run.

A conversation's rows are symbols (role, fault); equal neighbours are one run. The edits that
lead from one state of the output to another are a small min-plus matrix a symbol, a run is
one of its powers, put together from binary powers that are kept. The costs that remain are
carried backwards over the runs, then the choices are read off forwards.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslex.llm.common import picked, small_batches

#: What no text is made of alone.
BLANKS = " \t\n\x0b\x0c\r"
# Faults of a row, the first that holds counts; ends of a whole text.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
ENDS = [".", "!", "?"]
# Roles by their initials, and the two that edits can give.
INITIALS = "sua"
GIVEN = {"u": "user", "a": "assistant"}
# Costs of edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, STAYS = 0, 1, 2, 5, 5

# --- paths through one conversation -------------------------------------------

# States of the output, by its last role; where it may end; the state that the
# next given role leads to; where a kept role may stand.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (START, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
        "a": {USER: ASSISTANT}, "?": {}}
NEVER = 1 << 60

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def code_of(role: int, fault: int) -> int:
    """A row's symbol as a number; ``role`` is the place of its initial, 3 for others."""
    return role + 4 * fault


def symbol(code: int) -> tuple[str, int]:
    """Role and fault as far as they matter to edits: some faults can only be deleted."""
    role, fault = "sua?"[code % 4], code // 4
    return ("", BLANK) if fault in (BLANK, DUPLICATE) else (role, fault)


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[p][m] + b[m][q] for m in STATES) for q in STATES) for p in STATES)


def before(step: Matrix, togo: Vector) -> Vector:
    """Costs that remain before a step, from those after it."""
    return tuple(min(step[p][q] + togo[q] for q in STATES) for p in STATES)


def inserts() -> Matrix:
    """Costs of getting from state to state by inserted rows alone."""
    cost = [[0 if p == q else NEVER for q in STATES] for p in STATES]
    for p in STATES:
        state, spent = p, 0
        for _ in STATES:
            state, spent = NEXT[state], spent + INSERT
            cost[p][state] = min(cost[p][state], spent)
    return tuple(map(tuple, cost))


INSERTED = inserts()
#: Costs that remain after the last row.
AT_END: Vector = tuple(min(INSERTED[p][q] for q in FINAL) for p in STATES)


def choices(of: tuple[str, int], state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of one row in ASCII order of their initials: letter, cost, state after it."""
    role, fault = of
    yield "D", DELETE, state
    if fault in (SOUND, TRUNCATED):
        more = STAYS if fault == TRUNCATED else 0
        if state in KEPT[role]:
            yield "K", KEEP + more, KEPT[role][state]
        yield "R", REROLE + more, NEXT[state]


@lru_cache(maxsize=None)  # nine symbols, a power for each binary digit of a length
def power(of: tuple[str, int], k: int) -> Matrix:
    """Costs of 2 ** k rows of a symbol, with rows inserted before any of them."""
    if k:
        half = power(of, k - 1)
        return times(half, half)
    row = [[NEVER] * 4 for _ in STATES]
    for p in STATES:
        for _, cost, q in choices(of, p):
            row[p][q] = min(row[p][q], cost)
    return times(INSERTED, tuple(map(tuple, row)))


def digits(length: int) -> list[int]:
    """Binary digits of a length that are set."""
    return [k for k in range(length.bit_length()) if length >> k & 1]


def one_row(of: tuple[str, int], state: int, togo: Vector) -> tuple[str, int]:
    """Letters up to and including one row's own, and the state after it."""
    remains, letters = before(power(of, 0), togo), ""
    while True:
        options = [(letter, q, cost + togo[q]) for letter, cost, q in choices(of, state)]
        options.append(("I", NEXT[state], INSERT + remains[NEXT[state]]))
        letter, state = min((x, q) for x, q, total in options if total == remains[state])
        letters += letter
        if letter != "I":
            return letters, state


def unroll(of: tuple[str, int], k: int, state: int, togo: Vector) -> tuple[str, int]:
    """Letters of 2 ** k rows and the state after them: the least among the cheapest."""
    if k > 10:  # letters of longer stretches are not kept
        return halves(of, k, state, togo)
    least = min(togo)
    return kept_unroll(of, k, state, tuple(x - least for x in togo))


@lru_cache(maxsize=4096)
def kept_unroll(of, k, state, togo):
    return halves(of, k, state, togo) if k else one_row(of, state, togo)


def halves(of, k, state, togo):
    first, state = unroll(of, k - 1, state, before(power(of, k - 1), togo))
    second, state = unroll(of, k - 1, state, togo)
    return first + second, state


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as runs of ``(code, length)``."""
    blocks = []
    for of, same in groupby(((symbol(code), length) for code, length in runs), key=lambda x: x[0]):
        blocks += [(of, k) for k in digits(sum(length for _, length in same))]
    togo = [AT_END]
    for of, k in reversed(blocks):
        togo.append(before(power(of, k), togo[-1]))
    togo.reverse()
    state, audit = START, []
    for (of, k), after in zip(blocks, togo[1:]):
        letters, state = unroll(of, k, state, after)
        audit.append(letters)
    while state not in FINAL:
        audit.append("I")
        state = NEXT[state]
    return togo[0][START], "".join(audit)


@lru_cache(maxsize=20_000)
def kept_cheapest(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    return cheapest(list(runs))


LEGAL = {(0, 1), (1, 2), (2, 1)}


def judged(runs: list[tuple[int, int]]) -> dict:
    """Counts of faults and of illegal neighbours, cost and audit."""
    of_fault = [0] * 4
    for code, length in runs:
        of_fault[code // 4] += length
    steps = zip(runs, runs[1:])
    illegal = sum(length - 1 for _, length in runs) + sum(
        (a % 4, b % 4) not in LEGAL for (a, _), (b, _) in steps)
    short = len(runs) <= 16 and sum(length for _, length in runs) <= 64
    cost, audit = kept_cheapest(tuple(runs)) if short else cheapest(runs)
    return {"blank": of_fault[BLANK], "duplicate": of_fault[DUPLICATE],
            "truncated": of_fault[TRUNCATED], "illegal": illegal, "cost": cost, "audit": audit}


# --- symbols of all conversations, without their texts --------------------------

def standard(rows: DataFrame, conv_col: str, turn_col: str, role_col: str,
             text_col: str) -> DataFrame:
    """``conv, turn, role, text, digest``; null roles and texts are one space."""
    return picked(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col).select(
        "conv", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


ORDER = ["conv", "turn", "role", "digest"]


def symbols(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: ``conv, turn, role, digest, initial, fault, n, earlier``.

    ``earlier`` tells that another turn before this one has the same role and text. Only
    digests move; equal rows are counted before their shuffle, and a row meets the first
    turn of its text by that turn too, so no key holds a long conversation.
    """
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    same = rows.select(
        *ORDER, F.when(rest == "", BLANK).when(~F.right(rest, F.lit(1)).isin(ENDS), TRUNCATED)
        .otherwise(SOUND).alias("fault"),
        F.when(initial == "", 3).otherwise(
            F.pmod(F.position(initial, F.lit(INITIALS)) - 1, F.lit(4))).alias("initial"),
    ).groupBy(*ORDER, "initial", "fault").agg(F.count(F.lit(1)).alias("n"))
    # A turn that is null stands before the others.
    first = same.groupBy("conv", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first")).select(
        F.col("conv").alias("_conv"), F.col("role").alias("_role"),
        F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn"))
    on = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in ORDER]
    return same.join(first, on, "left").select(
        *ORDER, "initial", "fault", "n", F.col("_role").isNull().alias("earlier"))


SEGMENT = "place long, codes array<int>, lengths array<long>, first_turn long, last_turn long, turns long"
#: Runs in a segment at most.
SEGMENT_RUNS = 100_000


def _segments(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order, as runs: one row for each conversation of a task, more for a long one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        found: list[dict] = []
        open_: dict | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (
                "conv", "turn", "initial", "fault", "n", "earlier")]
            for conv, turn, initial, fault, n, earlier in zip(*columns):
                if open_ is None or conv != open_["conv"] or len(open_["codes"]) >= SEGMENT_RUNS:
                    place += 1
                    open_ = {"conv": conv, "place": place, "codes": [], "lengths": [],
                             "first_turn": None, "last_turn": None, "turns": 0}
                    found.append(open_)
                if turn is not None and turn != open_["last_turn"]:
                    if open_["first_turn"] is None:
                        open_["first_turn"] = turn
                    open_["last_turn"] = turn
                    open_["turns"] += 1
                again = code_of(initial, DUPLICATE)
                if fault == BLANK:
                    runs = [(code_of(initial, BLANK), n)]
                elif earlier:
                    runs = [(again, n)]
                else:
                    runs = [(code_of(initial, fault), 1), (again, n - 1)]
                for code, length in runs:
                    if not length:
                        continue
                    if open_["codes"] and open_["codes"][-1] == code:
                        open_["lengths"][-1] += length
                    else:
                        open_["codes"].append(code)
                        open_["lengths"].append(length)
            if len(found) > 1:  # the last may go on in the next batch
                yield pa.RecordBatch.from_pylist(found[:-1], schema)
                found = [open_]
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    return cut


def _gaps(segments: list[dict]) -> int:
    """Numbers missing between the first and the last turn."""
    known = [s for s in segments if s["turns"]]
    if not known:
        return 0
    again = sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:]))
    distinct = sum(s["turns"] for s in known) - again
    return known[-1]["last_turn"] - known[0]["first_turn"] + 1 - distinct


def _judge(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments of a conversation in order, as one row with its audit."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(batch.to_pylist() for batch in batches)
        done: list[dict] = []
        waiting = 0
        for conv, same in groupby(rows, key=lambda row: row["conv"]):
            segments = [s for s in same if s["codes"] is not None]
            pairs = chain.from_iterable(zip(s["codes"], s["lengths"]) for s in segments)
            runs = [(code, sum(length for _, length in equal))
                    for code, equal in groupby(pairs, key=lambda pair: pair[0])]
            done.append({"conv": conv, "gaps": _gaps(segments), **judged(runs)})
            waiting += len(done[-1]["audit"])
            if len(done) >= 1_000 or waiting > 1 << 22:
                yield pa.RecordBatch.from_pylist(done, schema)
                done, waiting = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return judge


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


FOUND = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string")


def audit(rows: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id",
          turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``<conv>, gaps, blank, duplicate, truncated, illegal, cost, audit`` a conversation.

    A row's first fault counts: blank, duplicate (role and text seen earlier), truncated (its
    last character that is no blank ends no sentence). ``illegal`` counts neighbours whose
    roles may not follow each other, ``gaps`` the turns missing. ``audit`` has the initials of
    the cheapest edits (Keep, Rerole, Delete, Insert) after which the roles are a system
    message or none and then pairs of user and assistant; of equally cheap ones the least in
    ASCII order. The repaired rows follow from it (:func:`repair`).

    Rows stand by turn, nulls first; those of one turn by role, then by the SHA-256 of their
    text. Null roles and texts are one space, an empty or unknown role is none of the three; a
    null conversation is one of its own. Conversations named in the table ``conversations``
    that have no rows are reported with zeros and an empty audit; an empty table has none.

    Only digests are sorted, into ranges that cut a long conversation into parts; each task
    sends on runs. One task then holds a conversation's runs and its audit, a letter a row,
    as the result does.
    """
    spark = rows.sparkSession
    small_batches(spark)
    plain = standard(rows, conv_col, turn_col, role_col, text_col)
    conv = plain.schema["conv"]
    shape = T.StructType([conv, *T._parse_datatype_string(SEGMENT).fields])
    segments = symbols(plain).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select(
        "conv", "turn", "initial", "fault", "n", "earlier",
    ).mapInArrow(_segments(_arrow(shape)), shape)
    named = picked(rows if conversations is None else conversations, conv=conv_col).distinct()
    empty = [F.lit(-1).cast("long").alias("place"), *[
        F.lit(None).cast(field.dataType).alias(field.name) for field in shape.fields[2:]]]
    result = T.StructType([conv, *T._parse_datatype_string(FOUND).fields])
    return segments.unionByName(named.select("conv", *empty)).repartition(
        "conv").sortWithinPartitions("conv", "place").mapInArrow(
        _judge(_arrow(result)), result).withColumnRenamed("conv", conv_col)


# --- the repaired rows ---------------------------------------------------------

def _edited(rows: Iterable[dict]) -> Iterator[tuple[dict, str, str, str, int | None]]:
    """Each edit of a conversation: ``found, letter, role, text, turn``. Its audit comes first."""
    rows = iter(rows)
    found = next(rows)["found"]
    state = START
    for letter in found["audit"]:
        row = None if letter == "I" else next(rows)
        if letter == "D":
            yield found, letter, row["role"], row["text"], row["turn"]
            continue
        if letter == "K":
            state = KEPT[row["role"][:1]][state]
            yield found, letter, row["role"], row["text"], row["turn"]
            continue
        state = NEXT[state]
        role = GIVEN["u" if state == USER else "a"]
        yield found, letter, role, "" if row is None else row["text"], row and row["turn"]


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    rows = chain.from_iterable(batch.to_pylist() for batch in batches)
    return groupby(rows, key=lambda row: row["conv"])


def _repaired(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for conv, rows in _by_conversation(batches):
            for place, (_, letter, role, text, turn) in enumerate(_edited(rows)):
                done.append({"conv": conv, "place": place, "edit": letter, "turn": turn,
                             "role": role, "text": text})
                size += len(text)
                if len(done) >= 2_000 or size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, size = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return write


def _digested(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for conv, rows in _by_conversation(batches):
            digest, between = hashlib.sha256(), b""
            head = next(rows)
            for _, letter, role, text, _ in _edited(chain([head], rows)):
                if letter != "D":
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
            done.append({"conv": conv, **head["found"], "repaired_sha256": digest.hexdigest()})
            if len(done) >= 1_000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return write


def _with_audits(rows: DataFrame, audits: DataFrame, conv_col: str, turn_col: str, role_col: str,
                 text_col: str) -> DataFrame:
    """The rows of a conversation in order in one task, its audit before them.

    Texts stream past and are not gathered.
    """
    small_batches(rows.sparkSession)
    plain = standard(rows, conv_col, turn_col, role_col, text_col)
    found = [field.split()[0] for field in FOUND.split(", ")]
    heads = audits.select(F.col(conv_col).alias("conv"), F.struct(*found).alias("found"))
    return heads.unionByName(plain, allowMissingColumns=True).repartition(
        "conv").sortWithinPartitions(
        "conv", F.col("found").isNull(), "turn", "role", "digest").drop("digest")


def repair(rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``<conv>, place, edit, turn, role, text``: all edits of all conversations, in order.

    ``audits`` is what :func:`audit` gave for the same rows. The repaired conversation is
    all but the rows whose edit is ``D``; inserted rows have no turn and an empty text.
    """
    both = _with_audits(rows, audits, conv_col, turn_col, role_col, text_col)
    shape = T.StructType([both.schema["conv"], *T._parse_datatype_string(
        "place long, edit string, turn long, role string, text string").fields])
    return both.mapInArrow(_repaired(_arrow(shape)), shape).withColumnsRenamed(
        {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col})


def repaired_digests(rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id",
                     turn_col: str = "turn", role_col: str = "role",
                     text_col: str = "text") -> DataFrame:
    """The audits with ``repaired_sha256``, of the repaired ``role:text`` joined by newlines.

    The digest reads a conversation's repaired rows one after the other, so one task
    streams them; none are held.
    """
    both = _with_audits(rows, audits, conv_col, turn_col, role_col, text_col)
    shape = T.StructType([both.schema["conv"], *T._parse_datatype_string(
        f"{FOUND}, repaired_sha256 string").fields])
    return both.mapInArrow(_digested(_arrow(shape)), shape).withColumnRenamed("conv", conv_col)


# --- damage, to have something to repair -----------------------------------------

def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with damage that follows from ``conv:turn``, in one of five ways or none.

    By the remainder of its CRC-32 by 20: 0 drops the row, 1 empties its text, 2 takes the
    ends of sentences out, 3 repeats it, 4 makes it a user's. Nulls of the key, roles and
    texts are one space.
    """
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    way = F.crc32(F.concat(spaced("conv"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    return picked(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col).withColumn(
        "way", way).where("way != 0").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col),
        F.when(F.col("way") == 4, "user").otherwise(spaced("role")).alias(role_col),
        F.when(F.col("way") == 1, "").when(
            F.col("way") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(
            spaced("text")).alias(text_col),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("way") == 3, 2).otherwise(1))).alias("_again"),
    ).drop("_again")
