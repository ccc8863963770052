"""The same results in SQL for DuckDB, over the test tables as views."""

from __future__ import annotations

from lakeferry import LOG_TABLES, SNAPSHOT_TABLES, TableSpec
from workload.inputs import whole_columns
from workload.queries import DOCUMENTS, LAST_OLD_EVENT_DAY, LAST_OLD_ORDER_DAY, SALT, STRICT_LOADS

ONE_DAY_KEY = 20240115
DELIMITERS = "chr(10) || chr(13) || chr(1)"


def _q(column: str) -> str:
    return f'"{column}"'


def _day(time: str) -> str:
    return f"CAST(strftime({time}, '%Y%m%d') AS INTEGER)"


def _stripped(text: str) -> str:
    return f"nullif(translate({text}, {DELIMITERS}, ''), '\\N')"


def _name(c: str) -> str:
    return f"""CASE
        WHEN strlen({c}) <= 9 THEN replace({c}, substr({c}, 2, 1), '*')
        WHEN strlen({c}) <= 12 THEN replace({c}, substr({c}, 2, 2), '**')
        WHEN strlen({c}) <= 24 THEN replace(
            {c}, substr({c}, 2, length({c}) - 2), repeat('*', length({c})))
        ELSE {c} END"""


def _phone(c: str) -> str:
    return f"CASE WHEN length({c}) >= 4 THEN replace({c}, substr({c}, 4, 4), '****') ELSE {c} END"


def _short_phone(c: str) -> str:
    return f"CASE WHEN length({c}) <= 4 THEN replace({c}, substr({c}, 4, 4), '*') ELSE {c} END"


def _hash(c: str, salt: str = "") -> str:
    return f"CASE WHEN length({c}) > 0 THEN sha256('{salt}' || {c}) ELSE {c} END"


def _strict_name(c: str) -> str:
    return f"""CASE
        WHEN length({c}) > 2 THEN
            substr({c}, 1, 1) || repeat('*', length({c}) - 2) || substr({c}, -1, 1)
        WHEN length({c}) = 2 THEN substr({c}, 1, 1) || '*'
        WHEN length({c}) = 1 THEN '*'
        ELSE {c} END"""


COMPAT_MASKS = {"name": _name, "phone": _phone, "short_phone": _short_phone, "hash": _hash}
STRICT_MASKS = {
    "name": _strict_name,
    "phone": _phone,
    "short_phone": _phone,
    "hash": lambda c: _hash(c, SALT),
}


def _phone_input(key: str) -> str:
    return f"""CASE WHEN {key} % 13 <> 0 THEN CAST(
        (13812345678 + ({key} * 7919) % 1000000000) % CAST(pow(10, 1 + {key} % 11) AS BIGINT)
        AS VARCHAR) END"""


def _card_input(key: str) -> str:
    return f"""CASE WHEN {key} % 11 = 0 THEN NULL
        WHEN {key} % 7 = 0 THEN '' ELSE '6222' || {key} END"""


def _person_input(key: str) -> str:
    return f"CASE WHEN {key} % 17 <> 0 THEN substr(text, 1, 1 + {key} % 30) END"


def _time(key: str) -> str:
    return f"""CASE WHEN {key} % 6 <> 0 AND {key} % 7 <> 0 THEN
        make_timestamp(2018, 4, 1 + {key} % 28, 1, 2, 3) END"""


def _spoiled(column: str, key: str) -> str:
    return f"CASE WHEN {key} % 9 <> 0 THEN '{column}_' || {key} END"


INPUTS = {
    "name": _person_input,
    "phone": _phone_input,
    "short_phone": _phone_input,
    "hash": _card_input,
}


def _snapshot_load(spec: TableSpec, is_strict: bool = False) -> str:
    kinds = {**spec.masks, **(spec.strict_masks if is_strict else {})}
    masks = STRICT_MASKS if is_strict else COMPAT_MASKS

    whole = whole_columns(spec)

    def given(column: str) -> str:
        if column == spec.key:
            value = "doc_id"
        elif column in spec.masks:
            value = _stripped(INPUTS[spec.masks[column]]("doc_id"))
        elif column in spec.datetimes:
            value = _time("doc_id")
        elif column in whole:
            value = _stripped(whole[column])
        else:
            value = _spoiled(column, "doc_id")
        return f"{value} AS {_q(column)}"

    def shown(column: str) -> str:
        if column in kinds:
            return f"{masks[kinds[column]](_q(column))} AS {_q(column)}"
        return _q(column)

    return f"""
        WITH staged AS (SELECT {", ".join(map(given, spec.columns))} FROM documents)
        SELECT {", ".join(map(shown, spec.columns))}, 'masked' AS layer FROM staged
        UNION ALL
        SELECT {", ".join(map(_q, spec.columns))}, 'raw' AS layer FROM staged"""


def _log_load(later: str, where: str, is_strict: bool = False) -> str:
    spec = LOG_TABLES["order_log"]
    given = {
        "id": "event_id",
        "uid": "user_id",
        "pay_price": "value",
        "red_price": later,
        "createtime": "ts",
        "finishtime": _time("event_id"),
        "shelltime": "ts",
        "attach": "props",
        "date": None if is_strict else "'date'",
    }
    kinds = spec.strict_masks if is_strict else {}
    masked = ", ".join(
        f"{STRICT_MASKS[kind](_q(column))} AS {_q(column)}" for column, kind in kinds.items()
    )
    shown = f"* REPLACE ({masked})" if masked else "*"
    columns = ", ".join(
        f"{given.get(column) or _labelled(column)} AS {_q(column)}" for column in spec.columns
    )
    return f"""
        WITH log AS (SELECT {columns}, {_day("ts")} AS yymmdd FROM events WHERE {where})
        SELECT {shown}, 'masked' AS layer FROM log UNION ALL SELECT *, 'raw' AS layer FROM log"""


def _labelled(column: str) -> str:
    return f"'{column}_' || event_id"


def _documents(lang: str, text: str, source: str) -> str:
    return f"SELECT doc_id, {text} AS text, {lang} AS lang, {source} AS source FROM cleaned"


EVENT_COLUMNS = "event_id, ts, event_type, value, props"
CLEANED = f"""WITH cleaned AS (
    SELECT doc_id, {_stripped("text")} AS text, lang, source FROM documents)"""
WORDS = """WITH words AS (
    SELECT doc_id, unnest(string_split(text, ' ')) AS word,
        CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS INTEGER) AS place
    FROM documents)"""
PHONES = f"WITH phones AS (SELECT c_custkey, {_phone_input('c_custkey')} AS phone FROM customer)"

ORACLE: dict[str, str] = {
    "src_snapshot": "SELECT * FROM customer",
    "src_split_numeric": "SELECT c_custkey, c_name, 1 AS readers, true AS fair FROM customer",
    "src_split_text": "SELECT c_custkey, c_name, 1 AS readers, true AS fair FROM customer",
    "src_day_shards": f"""
        SELECT event_id, ts, event_type, value,
            CASE WHEN {_day("ts")} > {LAST_OLD_EVENT_DAY} THEN props END AS props,
            {_day("ts")} AS yymmdd
        FROM events""",
    "clean_delims": f"""
        SELECT doc_id, translate(text, {DELIMITERS}, '') || lang AS text FROM documents""",
    "clean_null_token": """
        SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL
            WHEN event_id % 11 = 0 THEN '\\N.' ELSE event_type END AS event_type
        FROM events""",
    "clean_zero_date": """
        SELECT event_id, TRY_CAST(CASE WHEN event_id % 6 = 0 THEN '0000-00-00 00:00:00'
            WHEN event_id % 11 <> 0 THEN CAST(ts AS VARCHAR) END AS TIMESTAMP) AS ts
        FROM events""",
    "clean_tinyint": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0
            THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS finished
        FROM orders""",
    "clean_timezone": "SELECT event_id, ts + INTERVAL 8 HOUR AS ts FROM events",
    "project_allow_list": "SELECT c_name, c_mktsegment, c_custkey FROM customer",
    "project_constant": "SELECT c_custkey, c_name, 'date' AS date FROM customer",
    "schema_only": "SELECT c_name, c_mktsegment, c_custkey FROM customer WHERE 1 = 2",
    "schema_like": "SELECT c_name, c_mktsegment, c_custkey FROM customer",
    "schema_era": f"""
        SELECT o_orderkey, {_day("o_orderdate")} AS yymmdd, CASE
            WHEN {_day("o_orderdate")} > {LAST_OLD_ORDER_DAY} THEN o_totalprice END AS red_price
        FROM orders""",
    "mask_name": f"{WORDS} SELECT doc_id, place, word, {_name('word')} AS masked FROM words",
    "mask_phone": f"{PHONES} SELECT c_custkey, phone, {_phone('phone')} AS masked FROM phones",
    "mask_phone_short": f"""
        {PHONES} SELECT c_custkey, phone, {_short_phone('phone')} AS masked FROM phones""",
    "mask_hash": f"""
        WITH cards AS (SELECT c_custkey, {_card_input('c_custkey')} AS card FROM customer)
        SELECT c_custkey, card, {_hash('card')} AS masked FROM cards""",
    "mask_strict": f"""
        {WORDS} SELECT doc_id, place, {_strict_name('word')} AS name,
            {_phone('word')} AS phone, {_hash('word', SALT)} AS token
        FROM words""",
    "scalar_functions": """
        SELECT c_custkey,
            CAST(length(c_name) AS INTEGER) AS chars,
            CAST(strlen(c_name) AS INTEGER) AS bytes,
            CAST(octet_length(encode(c_name)) AS INTEGER) AS encoded_bytes,
            substr(c_name, 2, 3) AS piece,
            replace(c_name, '0', '*') AS replaced,
            repeat('*', c_custkey % 5) AS stars,
            sha256(c_name) AS digest,
            CAST(length(c_name) - 2 AS INTEGER) AS inner_chars,
            CASE WHEN c_custkey <= 100 THEN 'low' WHEN c_custkey >= 1000 THEN 'high'
                WHEN c_custkey > 500 THEN 'upper' WHEN c_custkey = 500 THEN 'middle'
                ELSE 'lower' END AS band
        FROM customer""",
    "publish_snapshot_latest": f"{CLEANED} {_documents('lang', 'text', 'source')}",
    "publish_two_layers": f"""{CLEANED}
        SELECT *, 'raw' AS layer FROM cleaned UNION ALL
        SELECT *, 'masked' AS layer FROM (
            {_documents(*[COMPAT_MASKS[DOCUMENTS.masks[c]](c) for c in ("lang", "text", "source")])})
        """,
    "stage_rerun": f"""
        SELECT event_id, ts, event_type, props, {_day("ts")} AS yymmdd,
            CASE WHEN {_day("ts")} = {ONE_DAY_KEY} THEN value * 2 ELSE value END AS value
        FROM events""",
    "publish_day": f"""
        SELECT {EVENT_COLUMNS}, {_day("ts")} AS yymmdd, layer
        FROM events, (VALUES ('masked'), ('raw')) AS layers(layer)
        WHERE {_day("ts")} = {ONE_DAY_KEY}""",
    "retention_survivors": f"""
        SELECT {EVENT_COLUMNS}, {_day("ts")} AS yymmdd FROM events
        WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 1 FROM events)""",
    "calendar_range": """
        WITH days AS (
            SELECT o_orderkey, unnest(generate_series(
                o_orderdate, o_orderdate + INTERVAL 1 DAY * CAST(o_orderkey % 6 - 1 AS INTEGER),
                INTERVAL 1 DAY)) AS day
            FROM orders)
        SELECT o_orderkey, strftime(day, '%Y%m%d') AS plain, strftime(day, '%Y-%m-%d') AS dashed,
            strftime(day, '%Y/%m/%d') AS slashed, strftime(day, '%Y.%m.%d') AS dotted
        FROM days""",
    "calendar_parse": f"""
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
                WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
                ELSE strftime(o_orderdate, 'day %Y%m%d') END AS spelled,
            CASE WHEN o_orderkey % 4 <> 3 THEN {_day("o_orderdate")} END AS yymmdd
        FROM orders""",
    "calendar_offsets": f"""
        SELECT o_orderkey, {_day("o_orderdate")} AS run_day,
            {_day("o_orderdate - INTERVAL 1 DAY")} AS one_before,
            {_day("o_orderdate - INTERVAL 2 DAY")} AS two_before
        FROM orders""",
    "pipe_order_log_backfill": _log_load(
        f"CASE WHEN {_day('ts')} > {LAST_OLD_EVENT_DAY} THEN value / 2 END", "1 = 1"
    ),
    "pipe_order_log_daily": _log_load("value / 2", f"{_day('ts')} = {ONE_DAY_KEY}"),
    **{f"pipe_{name}": _snapshot_load(spec) for name, spec in SNAPSHOT_TABLES.items()},
    **{
        f"pipe_{name}_strict": _snapshot_load(SNAPSHOT_TABLES[name], is_strict=True)
        for name in STRICT_LOADS
    },
    "pipe_numeric_mask": f"""
        WITH cleaned AS (
            SELECT doc_id, CAST(n_chars AS VARCHAR) AS n_chars, {_stripped("lang")} AS lang
            FROM documents)
        SELECT doc_id, {_phone("n_chars")} AS n_chars, lang, 'masked' AS layer FROM cleaned
        UNION ALL SELECT doc_id, n_chars, lang, 'raw' FROM cleaned""",
    "pipe_order_log_strict": _log_load(
        f"CASE WHEN {_day('ts')} > {LAST_OLD_EVENT_DAY} THEN value / 2 END", "1 = 1", is_strict=True
    ),
}
