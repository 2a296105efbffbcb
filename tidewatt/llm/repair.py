"""Repair of conversation structure by a shortest path over scalar big-integer weights.

Rows of a conversation are kept, given another role, deleted or preceded by inserted turns until
the initials of the roles read ``(s?(ua)+)?``. A path's weight is one integer: its high digits are
the cost, its low digits a fixed number of base-5 places, one for each edit in order
(D, I, K, R = 1 to 4, so ASCII order), zeros where no edit stands. The least integer is then the
cheapest repair whose edits are ASCII-least, and an ordinary minimum over a DAG decides everything.

A long conversation is cut into slices of ``SLICE`` rows. A slice yields the best path from each
state to each state. Joining slices needs no letters: paths that have just consumed a row and
differ never are prefixes of each other, so at a border the rank of a path among the four states
stands for all its letters so far. Weights therefore stay as short as a slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.llm.common import kept, table
from tidewatt.llm.turns import CRC32_SQL, content_digest, numbered

#: Rows of a conversation that one dynamic program handles.
SLICE = 256
BLANKS = " \t\n\x0b\x0c\r"
LETTERS = ".DIKR"
DELETE, INSERT, KEEP, REROLE = range(1, 5)
REROLED, DELETED, INSERTED, UNFINISHED = 1, 2, 5, 5
#: Faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_TURN = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Turns that must be inserted after the last row before a conversation may end.
CLOSING = (0, 2, 1, 0)


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """States that up to two inserted turns lead to; a third only returns to one of them, dearer."""
    for count in range(3):
        yield count, state
        state = NEXT_TURN[state]


def _steps() -> dict[tuple[int, str, int], list[tuple[int, int, tuple[int, ...]]]]:
    """(state, initial, fault) -> (next state, cost, edits) of every way to consume a row."""
    steps = {}
    for state in range(4):
        for initial in "sua-":
            for fault in range(4):
                ways = []
                for count, at in _inserted(state):
                    before, spent = (INSERT,) * count, INSERTED * count
                    ways.append((at, spent + DELETED, (*before, DELETE)))
                    if fault in (BLANK, DUPLICATE):
                        continue
                    late = UNFINISHED if fault == TRUNCATED else 0
                    ways.append((NEXT_TURN[at], spent + REROLED + late, (*before, REROLE)))
                    fits = SYSTEM if initial == "s" and at == START else NEXT_TURN[at] if initial == "sua"[NEXT_TURN[at] - 1] else None
                    if fits is not None:
                        ways.append((fits, spent + late, (*before, KEEP)))
                steps[state, initial, fault] = ways
    return steps


STEPS = _steps()


def best_paths(rows: list[tuple[str, int]], start: int) -> dict[int, tuple[int, str]]:
    """End state -> (cost, edits) of the least path over ``rows`` (initial, fault) from ``start``.

    Nodes are (row, state); an edge adds its cost times 5**places and its edits at the places that
    the path has reached. Inserted turns after the last row belong to whoever comes next.
    """
    places = 3 * len(rows)
    power = [5**p for p in range(places + 1)]
    unit = power[places]
    front = {start: (0, 0)}
    for initial, fault in rows:
        after: dict[int, tuple[int, int]] = {}
        for state, (weight, used) in front.items():
            for end, cost, edits in STEPS[state, initial, fault]:
                total = weight + cost * unit
                for place, edit in enumerate(edits, used + 1):
                    total += edit * power[places - place]
                if end not in after or total < after[end][0]:
                    after[end] = (total, used + len(edits))
        front = after
    found = {}
    for state, (weight, used) in front.items():
        cost, letters = divmod(weight, unit)
        found[state] = (cost, "".join(LETTERS[letters // power[places - p] % 5] for p in range(1, used + 1)))
    return found


def joined_paths(slices: Iterator[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """Cost and edits of a conversation from the best paths of its slices, in order.

    ``slices`` maps start state to ``best_paths``. The weight at a border is cost * 4 + rank, and
    the letters behind it are kept as a list of pieces for each state that is still alive.
    """
    alive: dict[int, tuple[int, int]] = {START: (0, 0)}
    back: list[dict[int, tuple[int, str]]] = []
    for paths in slices:
        best: dict[int, tuple[int, int, str]] = {}
        for state, (cost, rank) in alive.items():
            for end, (more, letters) in paths[state].items():
                weight = (cost + more) * 4 + rank
                if end not in best or weight < best[end][0]:
                    best[end] = (weight, state, letters)
        order = sorted(best, key=lambda end: (best[end][0] % 4, best[end][2]))
        alive = {end: (best[end][0] // 4, rank) for rank, end in enumerate(order)}
        back.append({end: (state, letters) for end, (_, state, letters) in best.items()})
    least, state = min((((cost + INSERTED * CLOSING[s]) * 4 + rank), s) for s, (cost, rank) in alive.items())
    pieces = ["I" * CLOSING[state]]
    for step in reversed(back):
        state, letters = step[state]
        pieces.append(letters)
    return least // 4, "".join(reversed(pieces))


def damaged(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text) after seeded damage; a null becomes one space (``turn`` stays null).

    crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of
    it, 3 repeats the row, 4 makes its role user. Rows without a conversation id are left out.
    """
    space = F.lit(" ")
    spot = F.concat_ws(":", F.col(conv).cast("string"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(spot.cast("binary")) % 20
    said = F.coalesce(F.col(text).cast("string"), space)
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role).cast("string"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    copies = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.drop("copies", "copy")


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("-")


def _slices(rows: DataFrame, size: int) -> DataFrame:
    """(conv_id, slice, rows): at most ``size`` small row records each, in order.

    Of a row only its initial, its faults and its turn travel; the text stays where it is.
    """
    tail = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select(
        "conv_id",
        "turn",
        content_digest(F.col("role"), F.col("text")).alias("digest"),
        _initial(F.col("role")).alias("initial"),
        F.when(tail == "", BLANK).when(~F.right(tail, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault"),
    )
    placed = kept(numbered(narrow, "conv_id", [F.asc_nulls_first("turn"), F.asc("digest")], "repair-turns"), "repair-rows")
    first = placed.groupBy("conv_id", "digest").agg(F.min("pos").alias("pos")).select("conv_id", "pos", F.lit(True).alias("first"))
    seen = F.when(F.col("first").isNull() & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))
    record = F.struct("pos", F.col("turn").cast("long").alias("turn"), "initial", seen.alias("fault"))
    return (
        placed.join(first, ["conv_id", "pos"], "left")
        .groupBy("conv_id", F.floor(F.col("pos") / size).cast("long").alias("slice"))
        .agg(F.sort_array(F.collect_list(record)).alias("rows"))
    )


_SLICE_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("slice", pa.int64())]
    + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns")]
    + [("first", pa.string()), ("last", pa.string()), ("starts", pa.list_(pa.int8())), ("ends", pa.list_(pa.int8()))]
    + [("costs", pa.list_(pa.int64())), ("letters", pa.list_(pa.string()))]
)
_SLICE_DDL = (
    "conv_id long, slice long, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, turns long, "
    "first string, last string, starts array<tinyint>, ends array<tinyint>, costs array<bigint>, letters array<string>"
)
LEGAL = {"su", "ua", "au"}


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and best paths of each slice; the first slice of a conversation starts in one state."""
    for batch in batches:
        out = []
        for conv, number, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            codes = [(r["initial"], r["fault"]) for r in rows]
            faults = [fault for _, fault in codes]
            initials = [initial for initial, _ in codes]
            turns = [r["turn"] for r in rows if r["turn"] is not None]
            paths = [(s, e, *found) for s in (range(4) if number else [START]) for e, found in best_paths(codes, s).items()]
            out.append(
                {
                    "conv_id": conv,
                    "slice": number,
                    "blank": faults.count(BLANK),
                    "duplicate": faults.count(DUPLICATE),
                    "truncated": faults.count(TRUNCATED),
                    "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
                    "first_turn": turns[0] if turns else None,
                    "last_turn": turns[-1] if turns else None,
                    "turns": len(set(turns)),
                    "first": initials[0],
                    "last": initials[-1],
                    "starts": [p[0] for p in paths],
                    "ends": [p[1] for p in paths],
                    "costs": [p[2] for p in paths],
                    "letters": [p[3] for p in paths],
                }
            )
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SLICE_SCHEMA)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _conversation(conv: int, slices: Iterator[dict]) -> dict:
    """Counts, cost and edits of one conversation from its slices in order."""
    sums = dict.fromkeys(_COUNTS, 0)
    first_turn = last_turn = last = None
    turns = 0

    def paths() -> Iterator[dict[int, dict[int, tuple[int, str]]]]:
        nonlocal first_turn, last_turn, last, turns
        for s in slices:
            for name in ("blank", "duplicate", "truncated", "illegal"):
                sums[name] += s[name]
            if last is not None and last + s["first"] not in LEGAL:
                sums["illegal"] += 1
            last = s["last"]
            if s["turns"]:
                turns += s["turns"] - (s["first_turn"] == last_turn)
                first_turn = s["first_turn"] if first_turn is None else first_turn
                last_turn = s["last_turn"]
            found: dict[int, dict[int, tuple[int, str]]] = {}
            for start, end, cost, letters in zip(s["starts"], s["ends"], s["costs"], s["letters"], strict=True):
                found.setdefault(start, {})[end] = (cost, letters)
            yield found

    sums["cost"], audit = joined_paths(paths())
    if first_turn is not None:
        sums["gaps"] = last_turn - first_turn + 1 - turns
    return {"conv_id": conv, **sums, "audit": audit}


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; its slices arrive in order and are taken one at a time."""
    schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in _COUNTS], ("audit", pa.string())])
    rows = (row for batch in batches for start in range(0, batch.num_rows, 64) for row in batch.slice(start, 64).to_pylist())
    ahead = next(rows, None)
    out = []

    def of(conv: int) -> Iterator[dict]:
        nonlocal ahead
        while ahead is not None and ahead["conv_id"] == conv:
            row, ahead = ahead, next(rows, None)
            yield row

    while ahead is not None:
        conv = ahead["conv_id"]
        out.append(_conversation(conv, of(conv)))
        if len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def audits(rows: DataFrame, size: int = SLICE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of ``rows``.

    ``rows`` has conv_id, turn, role and text, none null but turn. Rows follow their turn, null
    first, and within a turn the digest of role and text.
    """
    solved = _slices(rows, size).mapInArrow(_solved, _SLICE_DDL)
    ordered = solved.repartition("conv_id").sortWithinPartitions("conv_id", "slice")
    return ordered.mapInArrow(_folded, f"conv_id long, {', '.join(f'{n} long' for n in _COUNTS)}, audit string")


def apply_audit(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows: ``rows`` under the edits of ``audit``."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT_TURN[state]
        yield (role if edit == "K" else ROLE_OF[state]), text


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations: ``found`` is ``audits(rows)``."""
    return _with_audits(rows, found).mapInArrow(_repaired, "conv_id long, place long, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over the ``role:text`` lines of each repaired conversation."""
    return _with_audits(rows, found).mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, within one partition; no join is needed."""
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", content_digest(F.col("role"), F.col("text")).alias("digest"), "role", "text")
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("digest"), F.lit("").alias("role"), F.col("audit").alias("text"))
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "digest"]
    return texts.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[str, str]]]]:
    """(conversation, repaired rows) one after the other; rows are taken as they arrive."""
    rows = (row for batch in batches for start in range(0, batch.num_rows, 64) for row in zip(*(c.to_pylist() for c in batch.slice(start, 64).columns), strict=True))
    ahead = next(rows, None)

    def of(conv: int) -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            _, _, role, text = ahead
            ahead = next(rows, None)
            yield role, text

    while ahead is not None:
        conv, _, _, audit = ahead
        ahead = next(rows, None)
        own = of(conv)
        yield conv, apply_audit(audit, own)
        for _ in own:
            pass


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    out, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["conv_id", "place", "role", "text"])

    for conv, rows in _conversations(batches):
        for place, (role, text) in enumerate(rows):
            out.append((conv, place, role, text))
            size += len(text)
            if len(out) == 1000 or size > 1 << 20:
                yield batch()
                out, size = [], 0
    if out:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))

    for conv, rows in _conversations(batches):
        state, mark = hashlib.sha256(), ""
        for role, text in rows:
            state.update(f"{mark}{role}:{text}".encode())
            mark = "\n"
        out.append((conv, state.hexdigest()))
        if len(out) == 1000:
            yield batch()
            out = []
    if out:
        yield batch()


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, faults, cheapest edits and digest of the repaired text of every conversation.

    A conversation without rows after the damage has zeros, no edits and the empty text's digest.
    """
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    found = kept(audits(rows), "repair-audits")
    ids = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    whole = ids.join(found, "conv_id", "left").join(repaired_digests(rows, found), "conv_id", "left")
    none = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )


def _add(weight: str, cost: str, letters: str) -> str:
    """SQL: a text weight (10 digits of cost, then letters) after another edit; null stays null."""
    return f"(lpad((left({weight}, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({weight}, 11) || '{letters}')"


def _row_sql() -> str:
    """SQL: the four text weights after a row, from those before it."""
    inserted = {
        START: [("w0", 0)],
        SYSTEM: [("w1", 0)],
        USER: [("w2", 0), ("w0", 1), ("w1", 1), ("w3", 1)],
        ASSISTANT: [("w3", 0), ("w2", 1), ("w0", 2), ("w1", 2)],
    }
    opened = {s: f"least({', '.join(_add(w, str(5 * n), 'I' * n) for w, n in ways)})" for s, ways in inserted.items()}
    late, bound = "CASE WHEN r.fault = 3 THEN 5 ELSE 0 END", "r.fault IN (1, 2)"
    asks_user = f"least({opened[START]}, {opened[SYSTEM]}, {opened[ASSISTANT]})"

    def moved(source: str, initial: str) -> str:
        keep = f"CASE WHEN {bound} OR r.initial <> '{initial}' THEN NULL ELSE {_add(source, late, 'K')} END"
        role = f"CASE WHEN {bound} THEN NULL ELSE {_add(source, f'1 + {late}', 'R')} END"
        return f"{keep}, {role}"

    deleted = {s: _add(opened[s], "2", "D") for s in range(4)}
    system = f"CASE WHEN {bound} OR r.initial <> 's' THEN NULL ELSE {_add(opened[START], late, 'K')} END"
    return ",\n        ".join(
        f"{expr} AS w{state}"
        for state, expr in (
            (0, deleted[START]),
            (1, f"least({deleted[SYSTEM]}, {system})"),
            (2, f"least({deleted[USER]}, {moved(asks_user, 'u')})"),
            (3, f"least({deleted[ASSISTANT]}, {moved(opened[USER], 'a')})"),
        )
    )


#: The edits' letters are applied to the rows by list functions; the dynamic program is a recursive query.
OP12_SQL = f"""
WITH RECURSIVE known AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {CRC32_SQL.format(text="(conv_id::VARCHAR || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
    FROM conversations WHERE conv_id IS NOT NULL
), damage AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM known
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS pos FROM damage
), faulty AS (
    SELECT conv_id, turn, role, text, pos, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
           CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault
    FROM placed
), walk AS (
    SELECT conv_id, 0::BIGINT AS pos, '0000000000'::VARCHAR AS w0, NULL::VARCHAR AS w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3
    FROM (SELECT DISTINCT conv_id FROM faulty)
    UNION ALL
    SELECT r.conv_id, r.pos,
        {_row_sql()}
    FROM walk JOIN faulty r ON r.conv_id = walk.conv_id AND r.pos = walk.pos + 1
), counts AS (
    SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated
    FROM faulty GROUP BY conv_id
), pairs AS (
    SELECT conv_id, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM faulty) GROUP BY conv_id
), solved AS (
    SELECT c.*, least(w0, {_add("w1", "10", "II")}, {_add("w2", "5", "I")}, w3) AS best
    FROM counts c JOIN walk w ON w.conv_id = c.conv_id AND w.pos = c.n
), edits AS (
    SELECT conv_id, unnest(string_split(substr(best, 11), '')) AS edit, unnest(range(1, length(best) - 9)) AS place FROM solved
), consumed AS (
    SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS pos FROM edits
), turned AS (
    SELECT e.conv_id, e.place, e.edit, CASE WHEN e.edit <> 'I' THEN f.role END AS role, CASE WHEN e.edit <> 'I' THEN f.text ELSE '' END AS text, f.initial,
           count(*) FILTER (WHERE NOT (e.edit = 'K' AND f.initial = 's')) OVER (PARTITION BY e.conv_id ORDER BY place) AS nth
    FROM consumed e LEFT JOIN faulty f ON f.conv_id = e.conv_id AND f.pos = e.pos WHERE e.edit <> 'D'
), mended AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS sha
    FROM turned GROUP BY conv_id
)
SELECT i.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
       coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(p.illegal, 0)::BIGINT AS illegal, coalesce(left(s.best, 10)::BIGINT, 0) AS cost,
       coalesce(substr(s.best, 11), '') AS audit, coalesce(m.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) i
LEFT JOIN solved s ON s.conv_id = i.conv_id LEFT JOIN pairs p ON p.conv_id = i.conv_id LEFT JOIN mended m ON m.conv_id = i.conv_id
"""
