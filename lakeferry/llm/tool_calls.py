"""Tool calls in conversations: linked, ordered, validated, in canonical JSON.

Calls and results are joined by conversation and identifier; a call has the
first result of its identifier that comes after it. Arguments are JSON. A value
`{"$ref": id}` in them refers to the result of another call, so calls have an
order: as they come, except that a call stands behind all calls that it refers
to. Where all references of a conversation are to earlier calls, the usual case, that is
all. In the others of the large ones it is worked out by rounds of joins, in which each call
also keeps a pointer along its references that doubles in length: so chains of references, and
cycles, take rounds by the logarithm of their length (see `_walks` and `_places`). Arguments are
checked against the schema of their tool, and written with sorted keys and
without white space.

The text of calls and results is moved once: rows are dealt to ranges of
conversations, and each conversation is linked in the task that gets it (`_here`).
Conversations of over `MOST_ROWS` rows or `MOST_BYTES` of text are not gathered: there
each call stays a row, however long its conversation is, all is done by joins
(`_by_joins`), and the rows made are dealt to ranges of the order with the others. Both
ways make the same rows. They are sorted by conversation and order, in ranges.

Status, the first that holds: `no id`; `repeated` (not the first call of its
identifier); `bad json`; `unknown tool`; `invalid` (against the schema);
`missing` (refers to no call); `cycle` (refers to itself through others, or to
such a call); `unanswered`; `ok`. Results without a call are rows of status
`orphan`.

Defined results: equal rows count once; a null conversation is a conversation;
a null turn comes first; null arguments are bad JSON, null content is a result
of null. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.scratch import Scratch

Schema = Mapping[str, object]

#: rows, and bytes of text, of a conversation that is linked in one task
MOST_ROWS = 50_000
MOST_BYTES = 16 << 20

# kinds of rows dealt to the ranges: those of large conversations are made already
_CALL, _RESULT, _MADE = 0, 1, 2

_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def valid(value: object, schema: Schema) -> bool:
    """Whether a value meets a JSON schema (type, enum, bounds, properties, items).

    References stand for results and meet every schema.
    """
    if reference(value) is not None:
        return True
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[kind](value) for kind in kinds):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if _TYPES["number"](value):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    if isinstance(value, list):
        return all(valid(v, schema.get("items", {})) for v in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(name not in value for name in schema.get("required", [])):
            return False
        if schema.get("additionalProperties") is False and any(name not in known for name in value):
            return False
        return all(valid(v, known.get(name, {})) for name, v in value.items())
    return True


def reference(value: object) -> str | None:
    """The identifier that a value refers to, if it is a reference."""
    if isinstance(value, dict) and value.keys() == {"$ref"} and isinstance(value["$ref"], str):
        return value["$ref"]
    return None


def references(value: object) -> Iterator[str]:
    found = reference(value)
    if found is not None:
        yield found
    elif isinstance(value, (dict, list)):
        for inner in value.values() if isinstance(value, dict) else value:
            yield from references(inner)


_ENCODER = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def canonical(value: object) -> str:
    """JSON with sorted keys, no white space, and characters as they are."""
    return _ENCODER.encode(value)


def _refuse(name: str):
    raise ValueError(name)


_DECODER = json.JSONDecoder(parse_constant=_refuse)


def _parse(
    schemas: Mapping[str, Schema], name: str | None, arguments: str | None
) -> tuple[str | None, str | None, list[str]]:
    """The error of a call, its arguments as canonical JSON, and what they refer to."""
    try:
        if (arguments or "").startswith("\ufeff"):
            return "bad json", None, []
        value = _DECODER.decode(arguments or "")
        text = canonical(value)
    except (ValueError, RecursionError):
        return "bad json", None, []
    if name not in schemas:
        return "unknown tool", text, []
    error = None if valid(value, schemas[name]) else "invalid"
    return error, text, sorted(set(references(value)))


def _record(arguments: str | None, call_id: str | None, name: str | None, content: object) -> str:
    """A call and its result as JSON; the arguments are JSON already."""
    parts = (canonical(x) for x in (call_id, name, content))
    return '{{"arguments":{},"id":{},"name":{},"result":{}}}'.format(arguments or "null", *parts)


def _parsed(schemas: Mapping[str, Schema]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, arguments = (batch.column(c).to_pylist() for c in ("name", "arguments"))
            rows = [_parse(schemas, *row) for row in zip(names, arguments, strict=True)]
            errors, texts, refs = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "call_id", "turn", "name")),
                    pa.array(errors, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(refs, pa.list_(pa.string())),
                ],
                names=["conv_id", "call_id", "turn", "name", "error", "arguments", "refs"],
            )

    return run


def _on(left: str, right: str, mine: str = "call_id", other: str = "call_id"):
    conv = F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id"))
    return conv & (F.col(f"{left}.{mine}") == F.col(f"{right}.{other}"))


def _at(left: str, right: str, names: tuple[str, str]):
    conv = F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id"))
    return conv & (F.col(f"{left}.{names[0]}") == F.col(f"{right}.{names[1]}"))


def _tangled(calls: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The references of conversations in which one is to a call that doesn't come earlier."""
    turns = calls.select("conv_id", "call_id", F.struct("turn").alias("turn"))
    seen = edges.alias("e").join(turns.alias("c"), _on("e", "c"))
    seen = seen.join(turns.alias("r"), _on("e", "r", "ref")).where("r.turn >= c.turn")
    convs = scratch.save(seen.select("e.conv_id").distinct(), "tangled")
    same = F.col("e.conv_id").eqNullSafe(F.col("t.conv_id"))
    return scratch.save(edges.alias("e").join(convs.alias("t"), same, "left_semi"), "references")


def _walks(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, call_id, length, most) of a longest walk along references from each call that has any.

    In a round, a call takes the longest of the walks that go on from those it
    refers to, and from the end of its own: so walks double. One of `most` references,
    more than the conversation has, goes around a cycle, and is not followed any further.
    """
    sizes = edges.groupBy("conv_id").agg((F.count("*") + 1).alias("most"))
    sizes = scratch.save(sizes, "sizes")
    walks = edges.groupBy("conv_id", "call_id").agg(F.max("ref").alias("end"))
    same = F.col("w.conv_id").eqNullSafe(F.col("s.conv_id"))
    walks = walks.alias("w").join(sizes.alias("s"), same)
    one = F.lit(1).cast("long").alias("length")
    walks = scratch.save(walks.select("w.conv_id", "w.call_id", one, "w.end", "s.most"), "walks_0")
    turn = 0
    while True:
        on = edges.alias("e").join(walks.alias("w"), _at("e", "w", ("ref", "call_id")))
        on = on.select("e.conv_id", "e.call_id", (F.col("w.length") + 1).alias("length"), "w.end")
        twice = walks.alias("v").join(walks.alias("w"), _at("v", "w", ("end", "call_id")))
        twice = twice.select(
            "v.conv_id", "v.call_id", (F.col("v.length") + F.col("w.length")).alias("length"), "w.end"
        )
        best = on.unionByName(twice).groupBy("conv_id", "call_id")
        best = best.agg(F.max(F.struct("length", "end")).alias("best"))
        length = F.when(F.col("best.length").isNotNull(), F.least("best.length", "w.most"))
        longer = F.coalesce(length > F.col("w.length"), F.lit(False))
        found = walks.alias("w").join(best.alias("b"), _on("w", "b"), "left")
        found = found.select(
            "w.conv_id",
            "w.call_id",
            F.when(longer, length).otherwise(F.col("w.length")).alias("length"),
            F.when(longer, F.col("best.end")).otherwise(F.col("w.end")).alias("end"),
            "w.most",
            longer.alias("longer"),
        )
        turn += 1
        found = scratch.save(found, f"walks_{turn}")
        if found.where("longer").isEmpty():
            return found.drop("longer", "end")
        walks = found.drop("longer")
        scratch.drop(f"walks_{turn - 1}")


def _behind(steps):
    """So many steps behind the place of p."""
    return F.struct("p.place.turn", (F.col("p.place.step") + steps).alias("step")).alias("place")


def _places(calls: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, call_id, place) of calls that stand elsewhere than at their turn.

    A place is (turn, step): behind a call that stands at the same turn, a step
    later; null for calls in cycles or behind one. In a round, a call moves behind all
    that it refers to, and as far behind the place of the call that its pointer shows as
    that is away; the pointer then shows what that one's shows. It begins with the
    reference that the longest walk takes, and begins anew when all have come to their ends.
    """
    edges = _tangled(calls, edges, scratch)
    own = calls.select("conv_id", "call_id", F.struct("turn", F.lit(0).alias("step")).alias("place"))
    if edges.isEmpty():
        return own.where("1 = 2")
    walks = _walks(edges, scratch)
    endless = walks.where("length >= most").select("conv_id", "call_id")
    steps = edges.alias("e").join(endless.alias("x"), _on("e", "x"), "left_anti")
    ahead = steps.alias("e").join(walks.alias("w"), _at("e", "w", ("ref", "call_id")), "left")
    steps = scratch.save(
        ahead.select("e.conv_id", "e.call_id", "e.ref", F.coalesce("w.length", F.lit(0)).alias("length")), "steps"
    )
    first = steps.groupBy("conv_id", "call_id").agg(F.max(F.struct("length", "ref"))["ref"].alias("shown"))
    first = scratch.save(first.withColumn("away", F.lit(1)), "first_pointers")
    named = steps.select("conv_id", "call_id").unionByName(steps.select("conv_id", F.col("ref").alias("call_id")))
    own = scratch.save(own.alias("o").join(named.distinct().alias("s"), _on("o", "s"), "left_semi"), "own_places")
    places, pointers, turn = own, first, 0
    while True:
        behind = steps.alias("e").join(places.alias("p"), _at("e", "p", ("ref", "call_id")))
        behind = behind.select("e.conv_id", "e.call_id", _behind(F.lit(1)))
        jumped = pointers.alias("q").join(places.alias("p"), _at("q", "p", ("shown", "call_id")))
        jumped = jumped.select("q.conv_id", "q.call_id", _behind(F.col("q.away")))
        best = behind.unionByName(jumped).groupBy("conv_id", "call_id").agg(F.max("place").alias("best"))
        moved = F.coalesce(F.col("best") > F.col("p.place"), F.lit(False))
        found = places.alias("p").join(best.alias("b"), _on("p", "b"), "left").select(
            "p.conv_id",
            "p.call_id",
            F.when(moved, F.col("best")).otherwise(F.col("p.place")).alias("place"),
            moved.alias("moved"),
        )
        turn += 1
        found = scratch.save(found, f"places_{turn}")
        done = found.where("moved").isEmpty()
        places = found.drop("moved")
        if done:
            break
        on = pointers.alias("q").join(pointers.alias("r"), _at("q", "r", ("shown", "call_id"))).select(
            "q.conv_id", "q.call_id", "r.shown", (F.col("q.away") + F.col("r.away")).alias("away")
        )
        on = scratch.save(on, f"pointers_{turn}")
        # those that have come to an end have shown all there is
        pointers = first if on.isEmpty() else on
    moved = places.alias("p").join(own.alias("o"), _on("p", "o")).where("p.place > o.place").select("p.*")
    gone = endless.select("*", F.lit(None).cast(own.schema["place"].dataType).alias("place"))
    return scratch.save(moved.unionByName(gone), "moved")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("arguments", "call_id", "name", "content"))
        records = [_record(*row) for row in zip(*columns, strict=True)]
        names = batch.schema.names[:-3]
        kept = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(records, pa.string())], names=[*names, "record"])


def _by_joins(
    calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema], scratch: Scratch
) -> DataFrame:
    """The rows of `linked`, in no order, where each call is a row of its own from first to last."""
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments").distinct()
    results = results.select("conv_id", "turn", "call_id", "content").distinct()
    kinds = dict(calls.dtypes)
    parsed = calls.mapInArrow(
        _parsed(schemas),
        f"conv_id {kinds['conv_id']}, call_id string, turn {kinds['turn']}, name string,"
        " error string, arguments string, refs array<string>",
    )
    parsed = scratch.save(parsed, "parsed")
    least = F.min(F.struct("turn", "name", "arguments")).alias("least")
    firsts = parsed.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(least)
    firsts = firsts.select("conv_id", "call_id", "least.*")
    same = _on("p", "f") & F.struct("p.turn", "p.name", "p.arguments").eqNullSafe(
        F.struct("f.turn", "f.name", "f.arguments")
    )
    rows = parsed.alias("p").join(firsts.alias("f"), same, "left")
    rows = scratch.save(rows.select("p.*", F.col("f.call_id").isNotNull().alias("first")), "rows")
    scratch.drop("parsed")
    # without their text from here on
    firsts = rows.where("first").select("conv_id", "call_id", "turn").distinct()
    firsts = scratch.save(firsts, "firsts")

    edges = rows.where("first").select("conv_id", "call_id", F.explode("refs").alias("ref"))
    edges = edges.alias("e").join(firsts.alias("f"), _on("e", "f", "ref"), "left")
    edges = scratch.save(
        edges.select("e.*", F.col("f.call_id").isNotNull().alias("there")), "edges"
    )
    lost = edges.where("NOT there").select("conv_id", "call_id").distinct()
    places = _places(firsts, edges.where("there").drop("there"), scratch)

    answers = results.alias("r").join(firsts.alias("f"), _on("r", "f"), "left")
    answers = answers.select("r.*", F.col("f.turn").alias("asked"), F.col("f.call_id").isNotNull().alias("there"))
    after = answers.where("there AND (asked IS NULL OR turn > asked)")
    replies = after.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("reply"))

    rows = (
        rows.alias("p")
        .join(replies.alias("a"), _on("p", "a") & F.col("p.first"), "left")
        .join(places.alias("o"), _on("p", "o") & F.col("p.first"), "left")
        .join(lost.alias("l"), _on("p", "l") & F.col("p.first"), "left")
    )
    moved, cycle = F.col("o.call_id").isNotNull(), F.col("o.call_id").isNotNull() & F.col("o.place").isNull()
    status = (
        F.when(F.col("p.call_id").isNull(), "no id")
        .when(~F.col("p.first"), "repeated")
        .when(F.col("p.error").isNotNull(), F.col("p.error"))
        .when(F.col("l.call_id").isNotNull(), "missing")
        .when(cycle, "cycle")
        .when(F.col("a.reply").isNull(), "unanswered")
        .otherwise("ok")
    )
    own = F.struct(F.col("p.turn").alias("turn"), F.lit(0).alias("step"))
    place = F.when(moved, F.col("o.place")).otherwise(own)
    rows = rows.select(
        "p.conv_id",
        "p.call_id",
        "p.turn",
        F.col("a.reply.turn").alias("result_turn"),
        place["turn"].alias("order_turn"),
        place["step"].alias("order_step"),
        status.alias("status"),
        "p.name",
        "p.arguments",
        F.col("a.reply.content").alias("content"),
    )
    orphans = answers.where("NOT there").select(
        "conv_id",
        "call_id",
        F.lit(None).cast(kinds["turn"]).alias("turn"),
        F.col("turn").alias("result_turn"),
        F.lit(None).cast(kinds["turn"]).alias("order_turn"),
        F.lit(None).cast("int").alias("order_step"),
        F.lit("orphan").alias("status"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        "content",
    )
    every = rows.unionByName(orphans)
    schema = every.drop("name", "arguments", "content").withColumn("record", F.lit(None).cast("string")).schema
    return every.mapInArrow(_records, schema)


def _same(one: object, other: object) -> bool:
    """Equality as of groups: NULL is NULL, and NaN is NaN."""
    return one == other or (one != one and other != other)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """Rows of whole conversations; and rows that are made already, as they come."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        kinds, convs = (batch.column(c).to_pylist() for c in ("kind", "conv_id"))
        lo = 0
        while lo < len(kinds):
            made, hi = kinds[lo] == _MADE, lo + 1
            while hi < len(kinds) and (kinds[hi] == _MADE) == made:
                hi += 1
            if held and (made or not _same(last, convs[lo])):
                yield False, pa.Table.from_batches(held)
                held = []
            if made:
                yield True, pa.Table.from_batches([batch.slice(lo, hi - lo)])
            else:
                cut = hi - 1
                while cut > lo and _same(convs[cut - 1], convs[cut]):
                    cut -= 1
                if cut > lo:
                    yield False, pa.Table.from_batches([*held, batch.slice(lo, cut - lo)])
                    held = []
                held.append(batch.slice(cut, hi - cut))
                last = convs[hi - 1]
            lo = hi
    if held:
        yield False, pa.Table.from_batches(held)


def _ranks(turns: list) -> list[int]:
    """The place of each turn among the different ones, which come in order; 0 for null."""
    ranks, rank, before = [], 0, None
    for turn in turns:
        if turn is not None and (rank == 0 or not _same(turn, before)):
            rank, before = rank + 1, turn
        ranks.append(0 if turn is None else rank)
    return ranks


def _settled(own: Mapping[str, int], refs: Mapping[str, list[str]]) -> dict[str, tuple[int, int] | None]:
    """The place (turn, step) of each call behind all that it refers to; None in a cycle or behind one."""
    waits = {call: len(found) for call, found in refs.items()}
    behind: dict[str, list[str]] = {}
    for call, found in refs.items():
        for ref in found:
            behind.setdefault(ref, []).append(call)
    places: dict[str, tuple[int, int] | None] = {call: (turn, 0) for call, turn in own.items()}
    ready = [call for call in own if not waits.get(call)]
    while ready:
        turn, step = places[ref := ready.pop()]
        for call in behind.get(ref, ()):
            places[call] = max(places[call], (turn, step + 1))
            waits[call] -= 1
            if not waits[call]:
                ready.append(call)
    return places | {call: None for call, left in waits.items() if left}


def _conversation(
    schemas: Mapping[str, Schema], lo: int, hi: int, columns: Mapping[str, list]
) -> list[tuple]:
    """The rows of one conversation, in order: numbers of the rows that each turn comes from, and the rest."""
    kinds, ids, names, arguments, contents = (
        columns[c] for c in ("kind", "call_id", "name", "arguments", "content")
    )
    ranks = _ranks(columns["turn"][lo:hi])
    of = dict(zip(ranks, range(lo, hi), strict=True))  # a row of each turn
    calls, seen, least, refs = [], set(), {}, {}
    for i in range(lo, hi):
        if kinds[i] != _CALL:
            continue
        raw = (ranks[i - lo], ids[i], names[i], arguments[i])
        if raw in seen:
            continue
        seen.add(raw)
        error, text, found = _parse(schemas, names[i], arguments[i])
        # NULL comes first
        key = (ranks[i - lo], names[i] is not None, names[i] or "", text is not None, text or "")
        calls.append((i, key, error, text))
        if ids[i] is not None and (ids[i] not in least or key < least[ids[i]]):
            least[ids[i]], refs[ids[i]] = key, found
    asked = {call: key[0] for call, key in least.items()}
    lost = {call for call, found in refs.items() if any(ref not in least for ref in found)}
    refs = {call: there for call, found in refs.items() if (there := [ref for ref in found if ref in least])}
    tangled = any(asked[ref] >= asked[call] for call, found in refs.items() for ref in found)
    places = _settled(asked, refs) if tangled else {}

    rows, replies, orphans = [], {}, set()
    for i in range(lo, hi):
        if kinds[i] != _RESULT:
            continue
        rank, call = ranks[i - lo], ids[i]
        if call in asked:
            if call not in replies and (not asked[call] or rank > asked[call]):
                replies[call] = i
        elif (row := (rank, call, canonical(contents[i]))) not in orphans:
            orphans.add(row)
            order = (0, -1, 0, call is not None, call or "")
            rows.append((order, i, None, i, None, None, "orphan", _record(None, call, None, contents[i])))
    for i, key, error, text in calls:
        call = ids[i]
        first = call is not None and key == least[call]
        place = places.get(call, (key[0], 0)) if first else (key[0], 0)
        reply = replies.get(call) if first else None
        if call is None:
            status = "no id"
        elif not first:
            status = "repeated"
        elif error is not None:
            status = error
        elif call in lost:
            status = "missing"
        elif place is None:
            status = "cycle"
        else:
            status = "unanswered" if reply is None else "ok"
        turn, step = place or (0, None)
        order = (turn, -1 if step is None else step, key[0], call is not None, call or "")
        record = _record(text, call, names[i], None if reply is None else contents[reply])
        at = None if place is None else of[turn]
        rows.append((order, i, i, reply, at, step, status, record))
    return sorted(rows, key=lambda row: row[0])


def _here(schemas: Mapping[str, Schema]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Link the conversations of a task, whose rows come by conversation, turn, kind, identifier and content."""
    names = ["conv_id", "call_id", "turn", "result_turn", "order_turn", "order_step", "status", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made, table in _whole(batches):
            table = table.combine_chunks()
            if made:  # see `_dealt`
                table = table.select([*names[:-2], "name", "arguments"]).rename_columns(names)
                yield from table.to_batches()
                continue
            columns = {
                c: table.column(c).to_pylist()
                for c in ("conv_id", "turn", "kind", "call_id", "name", "arguments", "content")
            }
            convs = columns["conv_id"]
            starts = [0, *(i for i in range(1, len(convs)) if not _same(convs[i - 1], convs[i])), len(convs)]
            rows = []
            for lo, hi in zip(starts, starts[1:], strict=False):
                rows += _conversation(schemas, lo, hi, columns)
            _, at, turn, reply, order, step, status, record = zip(*rows, strict=True)
            take = lambda c, of: table.column(c).combine_chunks().take(pa.array(of, pa.int64()))
            made = pa.Table.from_arrays(
                [
                    take("conv_id", at),
                    take("call_id", at),
                    take("turn", turn),
                    take("turn", reply),
                    take("turn", order),
                    pa.array(step, pa.int32()),
                    pa.array(status, pa.string()),
                    pa.array(record, pa.string()),
                ],
                names=names,
            )
            yield from made.to_batches()

    return run


def _large(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id) of conversations that are not gathered in one task."""
    size = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long").alias("bytes")
    sizes = calls.select("conv_id", size("arguments")).unionByName(results.select("conv_id", size("content")))
    sizes = sizes.groupBy("conv_id").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))
    return sizes.where((F.col("rows") > MOST_ROWS) | (F.col("bytes") > MOST_BYTES)).select("conv_id")


def linked(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per call, and per result without one.

    `calls` has conv_id, turn, call_id, name and arguments (JSON), `results` has
    conv_id, turn, call_id and content. Columns: conv_id, call_id, turn,
    result_turn, order_turn and order_step (the place; null for cycles and
    orphans), status, and record, the call and its result as canonical JSON.
    """
    scratch = Scratch(calls.sparkSession)
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments")
    results = results.select("conv_id", "turn", "call_id", "content")
    kinds, others = dict(calls.dtypes), dict(results.dtypes)
    large = scratch.save(_large(calls, results), "large")
    made = None
    if not large.isEmpty():
        same = F.col("r.conv_id").eqNullSafe(F.col("x.conv_id"))
        # a row for MOST_ROWS rows or MOST_BYTES bytes of the input at most
        of = lambda frame, how: frame.alias("r").join(F.broadcast(large).alias("x"), same, how)
        made = _by_joins(of(calls, "left_semi"), of(results, "left_semi"), schemas, scratch)
        made = scratch.save(made, "made")
        calls, results = of(calls, "left_anti"), of(results, "left_anti")
    rows = _dealt(calls, results, made)
    types = {field.name: field.dataType for field in rows.schema}
    schema = T.StructType(
        [
            T.StructField("conv_id", types["conv_id"]),
            T.StructField("call_id", T.StringType()),
            *(T.StructField(c, types["turn"]) for c in ("turn", "result_turn", "order_turn")),
            T.StructField("order_step", T.IntegerType()),
            T.StructField("status", T.StringType()),
            T.StructField("record", T.StringType()),
        ]
    )
    found = rows.mapInArrow(_here(schemas), schema)
    cast = {"turn": kinds["turn"], "result_turn": others["turn"], "order_turn": kinds["turn"]}
    cast = {c: kind for c, kind in cast.items() if kind != types["turn"].simpleString()}
    return found.withColumns({c: F.col(c).cast(kind) for c, kind in cast.items()}) if cast else found


def _dealt(calls: DataFrame, results: DataFrame, made: DataFrame | None) -> DataFrame:
    """Calls and results in ranges of conversations, with the rows made of large ones in ranges of their order."""
    null = lambda kind: F.lit(None).cast(kind)
    turn = calls.select("turn").union(results.select("turn")).dtypes[0][1]
    content = dict(results.dtypes)["content"]
    none = [null(turn).alias(c) for c in ("result_turn", "order_turn")] + [null("int").alias("order_step")]
    calls = calls.select("*", null(content).alias("content"), F.lit(_CALL).alias("kind"), *none)
    text = [null("string").alias(c) for c in ("name", "arguments")]
    rows = calls.unionByName(results.select("*", *text, F.lit(_RESULT).alias("kind"), *none))
    if made is None:
        rows = rows.repartitionByRange("conv_id")
    else:
        names = [F.col("status").alias("name"), F.col("record").alias("arguments")]
        made = made.select("*", *names, null(content).alias("content"), F.lit(_MADE).alias("kind"))
        made = made.withColumns({c: F.col(c).cast(turn) for c in ("turn", "result_turn", "order_turn")})
        rows = rows.unionByName(made.drop("status", "record"))
        # a conversation that is linked in one task has one key
        own = [F.when(F.col("kind") == _MADE, F.col(c)) for c in ("turn", "call_id")]
        rows = rows.repartitionByRange("conv_id", "order_turn", "order_step", *own)
    return rows.sortWithinPartitions("conv_id", "order_turn", "order_step", "turn", "kind", "call_id", "content")
