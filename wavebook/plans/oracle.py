"""The same results in plain SQL for another engine, written apart from the operators.

Only the derived inputs are shared. JSON definitions are taken apart here with JSON
path functions, names are made with window functions, text is padded row by row.
"""

from __future__ import annotations

from wavebook.functions.text import TRANSLITERATION, WHITE_SPACE
from wavebook.plans.inputs import DEFINITION_EXPRESSIONS, ORDERS_NAMES, RESPONSE_EXPRESSIONS

RAW = f"raw as (select {', '.join(RESPONSE_EXPRESSIONS)} from orders)"
ANSWERS = [name.replace(".", "_") for name in ORDERS_NAMES]
ANY_ANSWER = "(" + " or ".join(f"coalesce({name}, '') <> ''" for name in ANSWERS) + ")"
LABELS = "('am selben Tag', 'in der Woche', 'im Monat', 'im Quartal', 'offen')"
DECODED = (
    "case V9 when 'p1' then 'am selben Tag' when 'p2' then 'in der Woche' when 'p3' then 'im Monat' "
    "when 'p4' then 'im Quartal' when 'p5' then 'offen' else V9 end"
)
ENUM = f"case when trim({DECODED}) in {LABELS} then trim({DECODED}) end"


def boolean(name: str) -> str:
    return f"case when {name} = '1' then true when {name} in ('0', '') then false end"


def integer(name: str) -> str:
    return f"cast(nullif(trim({name}), '') as bigint)"


CLEANED = f"""cleaned as (
    select {integer('vID')} as id, {boolean('vCOMPLETED')} as completed,
        {boolean('vFINISHED')} as finished, cast(vDURATION as double) as duration, vQUOTE as quote,
        strftime(cast(vSTART as timestamp), '%Y-%m-%d %H:%M:%S') as "start",
        strftime(cast(vEND as timestamp), '%Y-%m-%d %H:%M:%S') as "end",
        vRUNTIME as runtime, {integer('vPAGETIME1')} as pagetime1,
        {integer('vPAGETIME2')} as pagetime2, {integer('vPAGETIME3')} as pagetime3,
        {integer('vPAGETIME4')} as pagetime4,
        strftime(cast(vDATE as date), '%Y-%m-%d') as "date",
        {integer('V1')} as Q1_verpackung, {integer('V2')} as Q1_freundlich,
        {integer('V3')} as Q1_rechnung, {integer('V4')} as Q2, {boolean('V5')} as Q3_katalog,
        {boolean('V6')} as Q3_fernruf, {boolean('V7')} as Q3_webseite, {integer('V8')} as Q4,
        {ENUM} as Q5, {boolean('V10')} as Q6_schrauben, {boolean('V11')} as Q6_dichtungen,
        {boolean('V12')} as Q6_other, V12_1 as Q6_other_text, V13 as Q7_rampe, V14 as Q7_halle,
        V15 as Q8, V16 as Q9, load_counter
    from raw where vCOMPLETED <> '0' and {ANY_ANSWER})"""

# ---------------------------------------------------------------- definitions

DEFS = f"""defs as (select {', '.join(DEFINITION_EXPRESSIONS)} from part),
q as (
    select survey_id, i + 1 as question_position,
        json_extract(definition, '$[' || i || ']') as q
    from (select survey_id, definition,
              unnest(range(json_array_length(definition)::bigint)) as i from defs)),
base as (
    select survey_id, question_position, q,
        cast(json_extract_string(q, '$.id') as bigint) as question_id,
        cast(json_extract_string(q, '$.pageId') as bigint) as page_id,
        json_extract_string(q, '$.type') as type,
        json_extract_string(q, '$.question.de') as question_text,
        json_array_length(q, '$.groups')::bigint as n_groups,
        json_extract(q, '$.groups[0]') as g0,
        json_extract(q, '$.groups[1]') as g1,
        json_array_length(q, '$.groups[0].varnames')::bigint as n_vars,
        json_array_length(q, '$.groups[0].labels')::bigint as n_labels,
        lower(json_extract_string(q, '$.groups[0].inputType')) as input_type
    from q),
typed as (
    select *, case
        when type = 'INPUT' and n_groups = 1 then 'input_single_' || input_type
        when type = 'INPUT' and n_groups > 1 then 'input_multiple_' || input_type
        when type = 'MATRIX' and n_groups = 1 then 'matrix'
        when type = 'CHOICE' and n_groups = 1 and n_vars = 1 then 'single_choice'
        when type = 'CHOICE' and n_groups = 1 then 'multiple_choice'
        when type = 'CHOICE' and n_groups = 2 then 'multiple_choice_other'
        when type = 'SCALE' and n_groups = 1 then 'scale' end as question_type
    from base),
flagged as (
    select *, question_type is null as unknown_type, question_text is null as no_text,
        coalesce(question_type = 'matrix' and n_labels <= 1, false) as bad_matrix
    from typed),
valid as (
    select * from flagged where not unknown_type and not no_text and not bad_matrix)"""


def variable_rows(
    rows: str,
    name: str,
    kind: str,
    position: str,
    count: str,
    group: str = "0",
    label: str = "null",
    low: str = "null",
    high: str = "null",
    codes: str = "null",
    labels: str = "null",
    scale: str = "null",
    other_boolean: str = "false",
    other_text: str = "false",
) -> str:
    return f"""select survey_id, question_id, cast({group} as bigint) as group_id,
        {name} as id, question_position, question_type, {kind} as schema_variable_type,
        question_text, cast({label} as varchar) as label,
        cast({low} as double) as range_min, cast({high} as double) as range_max,
        cast({codes} as varchar) as possible_values_codes,
        cast({labels} as varchar) as possible_values_labels,
        cast({scale} as varchar) as scale_labels,
        {other_boolean} as is_other_boolean, {other_text} as is_other_text,
        cast({position} as bigint) as variable_position, cast({count} as bigint) as variable_count
    from {rows}"""


INPUT_KIND = "case when input_type = 'integer' then 'Int64' else 'String' end"
LABEL_I = "coalesce(json_extract_string(g0, '$.labels[' || i || '].de'), '')"
TEXTS = "list_transform(range(n_labels), lambda k: coalesce(json_extract_string(g0, '$.labels[' || k || '].de'), ''))"
CODES = "list_transform(range(json_array_length(g0, '$.codes')::bigint), lambda k: json_extract_string(g0, '$.codes[' || k || ']'))"
HAS_RANGE = "json_array_length(g0, '$.range')::bigint > 0"

VARIABLES = f"""{DEFS},
books as (
    select *, case when len(list_filter(codes, lambda c: trim(c) <> '')) = 0
        then list_transform(range(len(texts)), lambda k: cast(k + 1 as varchar)) else codes end as used
    from (select *, {TEXTS} as texts, {CODES} as codes
          from valid where question_type = 'single_choice')),
pairs as (
    select *, case when len(used) = len(texts) then
        list_filter(range(1, len(texts) + 1), lambda k: trim(used[k]) <> '' and texts[k] <> '')
        end as kept from books),
others as (
    select *, json_extract_string(g1, '$.varnames[0]') as text_name,
        split_part(json_extract_string(g1, '$.varnames[0]'), '.', 1) as other_name
    from valid where question_type = 'multiple_choice_other'),
options as (
    select *, json_extract_string(g0, '$.varnames[' || i || ']') as name, {LABEL_I} as text
    from (select *, unnest(range(n_vars)) as i from others)),
variables as (
    {variable_rows("valid where question_type like 'input_single_%'",
                   "json_extract_string(g0, '$.varnames[0]')", INPUT_KIND, "1", "1")}
    union all
    {variable_rows("(select *, unnest(range(n_groups)) as i from valid "
                   "where question_type like 'input_multiple_%')",
                   "json_extract_string(q, '$.groups[' || i || '].varnames[0]')", INPUT_KIND,
                   "i + 1", "n_groups", group="i",
                   label="json_extract_string(q, '$.groups[' || i || '].name.de')")}
    union all
    {variable_rows("(select *, unnest(range(n_vars)) as i from valid where question_type = 'matrix')",
                   "json_extract_string(g0, '$.varnames[' || i || ']')", "'Int64'",
                   "i + 1", "n_vars",
                   label="coalesce(json_extract_string(g0, '$.items[' || i || '].name.de'), '')",
                   low=f"case when {HAS_RANGE} then json_extract_string(g0, '$.range[0]') else '1' end",
                   high=f"case when {HAS_RANGE} then json_extract_string(g0, '$.range[1]') "
                        "else cast(n_labels as varchar) end",
                   scale=f"nullif(array_to_string(list_filter({TEXTS}, lambda t: t <> ''), '|'), '')")}
    union all
    {variable_rows("pairs", "json_extract_string(g0, '$.varnames[0]')", "'String'", "1", "1",
                   codes="case when len(kept) > 0 then "
                         "array_to_string(list_transform(kept, lambda k: used[k]), '|') end",
                   labels="case when len(kept) > 0 then "
                          "array_to_string(list_transform(kept, lambda k: texts[k]), '|') end")}
    union all
    {variable_rows("(select *, unnest(range(n_vars)) as i from valid "
                   "where question_type = 'multiple_choice')",
                   "json_extract_string(g0, '$.varnames[' || i || ']')", "'Boolean'",
                   "i + 1", "n_vars", label=LABEL_I)}
    union all
    {variable_rows("(select *, row_number() over (partition by survey_id, question_position "
                   "order by i) as place from options where name <> other_name)",
                   "name", "'Boolean'", "place", "n_vars + 1", label="text")}
    union all
    {variable_rows("options where name = other_name", "name", "'Boolean'", "n_vars", "n_vars + 1",
                   label="text", other_boolean="true")}
    union all
    {variable_rows("options where name = other_name", "text_name", "'String'", "n_vars + 1",
                   "n_vars + 1", group="1", label="text || ' (Text)'", other_text="true")}
    union all
    {variable_rows("valid where question_type = 'scale'",
                   "json_extract_string(g0, '$.varnames[0]')", "'Int64'", "1", "1",
                   low="json_extract_string(g0, '$.range[0]')",
                   high="json_extract_string(g0, '$.range[1]')")})"""

# ---------------------------------------------------------------- names

_BLANKS = f"'{WHITE_SPACE}'"


def transliterated(text: str) -> str:
    result = f"ltrim(trim({text}, {_BLANKS}), '_')"
    for letter, spelling in TRANSLITERATION.items():
        result = f"replace({result}, '{letter}', '{spelling}')"
    return result


def a_to_z_words(text: str) -> str:
    """SQL for the list of words of a-z letters in a text."""
    return (
        f"list_filter(regexp_split_to_array(lower({transliterated(text)}), '[^\\p{{L}}]+'), "
        "lambda w: regexp_full_match(w, '[a-z]+'))"
    )


def named(source: str) -> str:
    """CTEs from ``source`` (variables) to ``metadata``, with readable names."""
    letters = "'abcdefghijklmnopqrst'"
    place = "(variable_position - 1)"
    digits = ", ".join(
        f"case when {place} >= {20 ** n if n else 0} "
        f"then substr({letters}, cast({place} // {20**n} % 20 as int) + 1, 1) else '' end"
        for n in (3, 2, 1, 0)
    )
    return f"""worded as (
        select *, {a_to_z_words("coalesce(label, '')")} as words,
            {a_to_z_words("question_text")} as more_words
        from {source}),
    picked as (
        select * exclude (words, more_words),
            variable_count = 1 or (question_type = 'multiple_choice_other'
                and (is_other_boolean or is_other_text)) as by_rule,
            regexp_replace(coalesce(
                list_filter(words, lambda w: length(w) =
                    list_max(list_transform(words, lambda x: length(x))))[1],
                list_filter(more_words, lambda w: length(w) =
                    list_max(list_transform(more_words, lambda x: length(x))))[1],
                'option'), 'xx+', 'x', 'g') as word
        from worded),
    counted as (
        select *, row_number() over (
            partition by survey_id, question_position, by_rule, word
            order by variable_position) as used from picked),
    metadata as (
        select * exclude (id, by_rule, word, used), id as original_id,
            'Q' || question_position || case
                when by_rule and is_other_text then '_other_text'
                when by_rule and is_other_boolean then '_other'
                when by_rule then ''
                when used = 1 and not (question_type = 'multiple_choice_other' and word = 'other')
                    then '_' || word
                else '_' || word || 'xx' || concat({digits}) end as id
        from counted)"""


PART_METADATA = VARIABLES + ",\n" + named("variables")

DOCUMENT_VARIABLES = f"""doc_lines as (
    select doc_id, source, lang, list_filter(string_split(text, chr(10)),
        lambda l: trim(l, {_BLANKS}) <> '') as lines from documents),
variables as (
    select source as survey_id, doc_id as question_id, cast(0 as bigint) as group_id,
        'V' || doc_id || '.' || i as id, doc_id + 1 as question_position,
        'multiple_choice' as question_type, 'Boolean' as schema_variable_type,
        lang as question_text, lines[i + 1] as label,
        cast(null as double) as range_min, cast(null as double) as range_max,
        cast(null as varchar) as possible_values_codes,
        cast(null as varchar) as possible_values_labels, cast(null as varchar) as scale_labels,
        false as is_other_boolean, false as is_other_text,
        cast(i + 1 as bigint) as variable_position, cast(len(lines) as bigint) as variable_count
    from (select *, unnest(range(len(lines))) as i from doc_lines))"""
DOCUMENT_METADATA = DOCUMENT_VARIABLES + ",\n" + named("variables")

ALL_VARIABLE_COLUMNS = (
    "survey_id, question_id, group_id, id, question_position, question_type, "
    "schema_variable_type, question_text, label, range_min, range_max, possible_values_codes, "
    "possible_values_labels, scale_labels, is_other_boolean, is_other_text, variable_position, "
    "variable_count"
)
NAMES = "survey_id, question_position, original_id, id"


def with_(ctes: str, select: str) -> str:
    return f"with {ctes}\n{select}"


# ---------------------------------------------------------------- dictionary

_LOW = "coalesce(cast(range_min as varchar), 'None')"
_HIGH = "coalesce(cast(range_max as varchar), 'None')"
RANGE = f"""case when range_min is null and range_max is null then ''
    else '[' || {_LOW} || ', ' || {_HIGH} || ']' end"""


def one_line(text: str) -> str:
    return f"regexp_replace({text}, '\\s*[\\r\\n]+\\s*', ' ', 'g')"


def dictionary_lines(metadata: str) -> str:
    """CTEs up to ``lines``: every line of every survey's dictionary after the overview."""
    cells = {
        "Variable": "variable",
        "Label": "label",
        "Data Type": "data_type",
        "Range": "range_text",
        "Possible Values": "choices",
    }
    shown = {
        "scale": ["Variable", "Data Type", "Range"],
        "matrix": ["Variable", "Label", "Data Type", "Range"],
        "single_choice": ["Variable", "Data Type", "Possible Values"],
        "input_single_singleline": ["Variable", "Data Type"],
        "input_single_multiline": ["Variable", "Data Type"],
    }

    def per_type(line) -> str:
        cases = " ".join(f"when '{kind}' then {line(names)}" for kind, names in shown.items())
        return f"case question_type {cases} else {line(['Variable', 'Label', 'Data Type'])} end"

    def table_line(value) -> str:
        def line(names):
            padded = [f"rpad({value(n)}, cast(w_{cells[n]} as int), ' ')" for n in names]
            return "concat('| ', " + ", ' | ', ".join(padded) + ", ' |')"

        return per_type(line)

    def rule(names) -> str:
        parts = [f"repeat('-', cast(w_{cells[n]} + 2 as int))" for n in names]
        return "concat('|', " + ", '|', ".join(parts) + ", '|')"

    over = "over (partition by survey_id, question_id)"
    widths = ", ".join(
        f"greatest(max(length({column})) {over}, {len(heading)}) as w_{column}"
        for heading, column in cells.items()
    )
    head = [
        "'### Q' || question_position || ': ' || question",
        "''",
        "'**Type:** ' || question_type",
        "''",
        "'**Variables:** ' || size",
        "''",
        table_line(lambda n: f"'{n}'"),
        per_type(rule),
    ]
    heads = " union all ".join(
        f"select survey_id, question_id, 1 as part, {n} as place, {text} as line "
        "from cells where variable_position = 1"
        for n, text in enumerate(head)
    )
    return f"""{metadata},
    texts as (
        select survey_id, question_id, question_position, question_type, variable_position,
            {one_line('question_text')} as question, id as variable,
            {one_line("coalesce(label, '')")} as label, schema_variable_type as data_type,
            {RANGE} as range_text,
            {one_line("coalesce(replace(possible_values_labels, '|', '; '), '')")} as choices
        from metadata),
    cells as (select *, count(*) {over} as size, {widths} from texts),
    lines as (
        {heads}
        union all
        select survey_id, question_id, 2 as part, variable_position as place,
            {table_line(lambda n: cells[n])} as line from cells
        union all
        select survey_id, question_id, 3 as part, 0 as place, '' as line
        from cells where variable_position = 1)"""


LINE_COLUMNS = "survey_id, question_id, cast(part as bigint) as part, cast(place as bigint) as place, line"

# ---------------------------------------------------------------- statements


def share(count: str, total: str) -> str:
    return f"cast(({count} * 20000 + {total}) // (2 * {total}) as bigint) / 100.0::double"


def frequency(source: str, column: str, where: str = "", ctes: str = "") -> str:
    prefix = f"{ctes}, " if ctes else ""
    return f"""with {prefix}counts as (
        select {column} as response, count(*) as "count" from {source} {where} group by 1)
    select response, cast("count" as bigint) as "count",
        {share('"count"', '(select sum("count") from counts)')} as percentage from counts"""


def trend(column: str, function: str, rounded: bool = False) -> str:
    value = f"{function}(cast({column} as double))"
    value = f"round({value}, 6)" if rounded else f"cast({value} as {'bigint' if function == 'count' else 'double'})"
    return with_(
        f"{RAW}, {CLEANED}",
        f"""select load_counter as wave, {value} as avg_value,
            cast(count({column}) as bigint) as response_count
        from cleaned where {column} is not null group by 1""",
    )


def flattened(condition: str) -> str:
    return with_(VARIABLES, f"select {ALL_VARIABLE_COLUMNS} from variables where {condition}")


def check_counts() -> list[tuple[str, str, str]]:
    """Column, check and failures for the tightened contract: rows, or 1 for the schema."""
    every, none = "1", "0"
    system = {
        "id", "completed", "finished", "duration", "quote", "start", "end", "runtime", "date",
        "pagetime1", "pagetime2", "pagetime3", "pagetime4",
    }
    found = []
    for name in [*ORDERS_NAMES.values(), *sorted(system)]:
        found.append((name, "column_present", none))
        found.append((name, "type", every if name == "Q3_katalog" else none))
        if name in system or name == "Q1_rechnung":
            found.append((name, "not_null", f'count(*) filter (where "{name}" is null)'))
    found.append(("pagetime5", "column_present", every))
    found.append(("Q5", "allowed_values", "count(*) filter (where Q5 = 'im Monat')"))
    found.append(("Q4", "in_range", "count(*) filter (where Q4 < 20)"))
    found.append(("Q2", "in_range", "count(*) filter (where Q2 < 1 or Q2 > 5)"))
    for name, high in (("Q1_verpackung", 4), ("Q1_freundlich", 4)):
        found.append((name, "in_range", f"count(*) filter (where {name} < 1 or {name} > {high})"))
    found.append(("Q1_rechnung", "in_range", "count(*) filter (where Q1_rechnung > 1)"))
    return found


def checks(check: str | None = None) -> str:
    parts = [
        f"select '{name}' as column_name, '{kind}' as \"check\", "
        f"cast({count} as bigint) as failures" + " from cleaned" * ("(" in count)
        for name, kind, count in check_counts()
        if check in (None, kind)
    ]
    return with_(f"{RAW}, {CLEANED}", " union all ".join(parts))


NOT_NULL_METADATA = [
    "survey_id", "question_id", "group_id", "id", "question_position", "question_type",
    "schema_variable_type", "question_text", "is_other_boolean", "is_other_text",
    "variable_position", "variable_count", "original_id",
]
NULLABLE_METADATA = [
    "label", "range_min", "range_max", "possible_values_codes", "possible_values_labels",
    "scale_labels",
]


def metadata_checks() -> str:
    parts = []
    for name in [*NOT_NULL_METADATA, *NULLABLE_METADATA]:
        for kind in ("column_present", "type"):
            parts.append(f"select '{name}' as column_name, '{kind}' as \"check\", 0::bigint as failures")
        if name in NOT_NULL_METADATA:
            count = f"count(*) filter (where {name} is null)"
            parts.append(
                f"select '{name}' as column_name, 'not_null' as \"check\", {count} as failures from broken"
            )
    raw = "count(*) filter (where id like 'V%' and regexp_matches(substr(id, 2, 2), '[0-9]'))"
    parts.append(f"select 'id' as column_name, 'no_raw_name' as \"check\", {raw} as failures from broken")
    broken = """broken as (
        select * replace (
            case when question_position <> 2 then question_text end as question_text,
            case when question_position = 4 then original_id else id end as id)
        from metadata)"""
    return with_(f"{PART_METADATA}, {broken}", " union all ".join(parts))


CHANGED = """changed as (
    select survey_id,
        case when cast(survey_id as bigint) % 30 = 0 and original_id = 'V5' then 'V5x'
            else original_id end as original_id,
        case when cast(survey_id as bigint) % 50 = 0 and question_type = 'scale' then 'matrix'
            else question_type end as question_type
    from metadata where not (cast(survey_id as bigint) % 20 = 0 and original_id = 'V31'))"""


def multiset_difference(stored: str, new: str) -> str:
    keys = "survey_id, original_id, question_type"
    return f"""select {keys}, 'added' as change, cast(count(*) as bigint) as copies
        from (select {keys} from {new} except all select {keys} from {stored}) group by all
    union all
    select {keys}, 'missing' as change, cast(count(*) as bigint) as copies
        from (select {keys} from {stored} except all select {keys} from {new}) group by all"""


def statements() -> dict[str, str]:
    raw_columns = (
        "vID, vCOMPLETED, vFINISHED, vDURATION, vQUOTE, vSTART, vEND, vRUNTIME, vPAGETIME1, "
        "vPAGETIME2, vPAGETIME3, vPAGETIME4, vDATE"
    )
    system = (
        'vID as id, vCOMPLETED as completed, vFINISHED as finished, vDURATION as duration, '
        'vQUOTE as quote, vSTART as "start", vEND as "end", vRUNTIME as runtime, '
        "vPAGETIME1 as pagetime1, vPAGETIME2 as pagetime2, vPAGETIME3 as pagetime3, "
        "vPAGETIME4 as pagetime4, vDATE as \"date\""
    )
    answers = ", ".join(ANSWERS)
    renamed = ", ".join(f"{raw.replace('.', '_')} as {new}" for raw, new in ORDERS_NAMES.items())
    cleaned = f"{RAW}, {CLEANED}"
    long_values = " union all ".join(
        f"select '{name}' as variable, cast({name} as varchar) as response from cleaned "
        f"where {name} is not null"
        for name in ORDERS_NAMES.values()
    )
    numeric = ["Q1_verpackung", "Q1_freundlich", "Q1_rechnung", "Q2", "Q4", "Q9"]
    trends = " union all ".join(
        f"select '{name}' as variable, load_counter as wave, avg(cast({name} as double)) as avg_value, "
        f"cast(count({name}) as bigint) as response_count from cleaned where {name} is not null group by 2"
        for name in numeric
    )
    groups = f"""{DEFS}, g as (
        select survey_id, question_position, i as "group",
            json_extract(q, '$.groups[' || i || ']') as g
        from (select *, unnest(range(n_groups)) as i from base))"""

    def group_texts(path: str, field: str) -> str:
        return (
            f"array_to_string(list_transform(range(json_array_length(g, '$.{path}')::bigint), "
            f"lambda k: coalesce(json_extract_string(g, '$.{path}[' || k || ']{field}'), '-')), '|')"
        )

    return {
        # sources and sinks
        "read_questions": with_(
            DEFS,
            """select survey_id, question_position, question_id,
                cast(json_extract_string(q, '$.pollId') as bigint) as poll_id, page_id, type,
                false as anonym, false as mandatory, cast(n_groups as bigint) as groups,
                array_to_string(flatten(list_transform(range(n_groups), lambda k:
                    list_transform(range(json_array_length(q, '$.groups[' || k || '].varnames')::bigint),
                        lambda v: json_extract_string(q, '$.groups[' || k || '].varnames[' || v || ']')))), '|')
                    as varnames
            from base""",
        ),
        "normalize_questions": with_(
            groups,
            f"""select survey_id, question_position, "group",
                coalesce(json_extract_string(g, '$.name.de'), '-') as name,
                {group_texts('labels', '.de')} as labels,
                case when json_array_length(g, '$.range')::bigint > 0 then
                    array_to_string(list_transform(range(json_array_length(g, '$.range')::bigint), lambda k:
                        json_extract_string(g, '$.range[' || k || ']')), '|') end as "range",
                {group_texts('items', '.name.de')} as items
            from g""",
        ),
        "read_responses": with_(
            RAW, f"select {raw_columns}, vANONYM, vLANG, {answers} from raw"
        ),
        "read_responses_line_breaks": "select cast(doc_id as varchar) as vID, md5(text) as text_md5, "
        "length(text) as characters from documents",
        "read_responses_split": "select cast(doc_id as varchar) as vID, md5(text) as text_md5, "
        "length(text) as characters from documents",
        "read_definitions": f"""with defs as (select {', '.join(DEFINITION_EXPRESSIONS)} from part)
            select md5(definition) as definition_md5, cast(count(*) as bigint) as files
            from defs group by 1""",
        "read_response_envelopes": with_(
            RAW, f"select {raw_columns}, vANONYM, vLANG, {answers} from raw"
        ),
        "load_wave": with_(
            cleaned,
            """select id % 2 as load_counter, cast(count(*) as bigint) as responses,
                cast(sum(Q4) as bigint) as branches, cast(count(Q5) as bigint) as chosen,
                sum(cast(Q9 as double)) as kilometers
            from cleaned group by 1""",
        ),
        "validate_allowed_values_long": """select 'customer' as column_name,
                'allowed_values' as "check", cast(count(*) filter (where name is not null and
                    name not in (select c_name from customer)) as bigint) as failures
            from (select case when o_orderkey % 9 = 0 then null when o_orderkey % 10 = 0 then 'nobody'
                else 'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') end as name from orders)
            union all select 'customer', 'column_present', 0
            union all select 'customer', 'type', 0""",
        "write_wave": with_(
            cleaned,
            """select load_counter, cast(count(*) as bigint) as responses,
                cast(sum(Q4) as bigint) as branches, cast(count(Q5) as bigint) as chosen,
                cast(count(*) filter (where Q6_other) as bigint) as others
            from cleaned group by 1""",
        ),
        "append_wave": with_(
            cleaned, 'select load_counter, id, "start", Q2, Q4, Q5, Q3_katalog, Q9 from cleaned'
        ),
        "read_table": with_(
            cleaned,
            """select Q5, cast(count(*) as bigint) as answers, avg(Q2) as mean from cleaned
            where load_counter >= 2 and Q5 is not null group by 1""",
        ),
        "free_sql": with_(
            cleaned,
            """select load_counter, Q6_other, cast(count(*) as bigint) as answers,
                max(Q4) as most_branches from cleaned group by 1, 2""",
        ),
        "write_dictionary": with_(
            dictionary_lines(DOCUMENT_METADATA),
            """select survey_id, cast(count(*) as bigint) as lines,
                cast(count(*) filter (where line like '### %') as bigint) as sections,
                cast(count(*) filter (where line like '| Q%') as bigint) as rows,
                cast(sum(length(line)) as bigint) as characters
            from (
                select survey_id, line from lines
                union all
                select survey_id, unnest(['# Survey Documentation', '', '## Overview', '',
                    'Total questions: ' || count(distinct question_id), '',
                    'Total variables: ' || count(*), '', '## Questions', '']) as line
                from metadata group by survey_id)
            group by 1""",
        ),
        # rows and columns
        "filter_completed": with_(RAW, "select vID, vCOMPLETED from raw where vCOMPLETED <> '0'"),
        "filter_non_empty": with_(RAW, f"select vID, V8, V13, V15 from raw where {ANY_ANSWER}"),
        "drop_columns": with_(RAW, f"select {raw_columns}, {answers} from raw"),
        "rename_from_metadata": with_(RAW, f"select {system}, {renamed} from raw"),
        "add_wave": with_(RAW, "select vID, vDATE, 3::bigint as load_counter from raw"),
        "decode_single_choice": with_(RAW, f"select vID, {DECODED} as decoded from raw"),
        "decode_long_code_book": """select o_orderkey, c_name as customer from orders
            left join customer on o_custkey = c_custkey and o_orderkey % 5 <> 0""",
        "decode_long": with_(RAW, f"select vID, V9 as value, {DECODED} as label from raw"),
        "clean_responses": with_(cleaned, "select * from cleaned"),
        # casts
        "cast_boolean": with_(RAW, f"select vID, {boolean('V6')} as value from raw"),
        "cast_integer": with_(RAW, f"select vID, {integer('V8')} as value from raw"),
        "cast_double": with_(RAW, "select vID, cast(vDURATION as double) as value from raw"),
        "cast_date": with_(
            RAW, "select vID, strftime(cast(vDATE as date), '%Y-%m-%d') as value from raw"
        ),
        "cast_timestamp": with_(
            RAW,
            "select vID, strftime(cast(vEND as timestamp), '%Y-%m-%d %H:%M:%S') as value from raw",
        ),
        "cast_enum": with_(RAW, f"select vID, {ENUM} as value from raw"),
        # definitions
        "classify_question": with_(
            DEFS, "select survey_id, question_position, type, question_type from typed"
        ),
        "question_violations": with_(
            DEFS,
            """select survey_id, question_position, question_id,
                unnest(list_filter([
                    case when no_text then 'no German (''de'') question text' end,
                    case when unknown_type then 'unknown question type for this number of groups' end,
                    case when bad_matrix then 'a matrix has more than one item, as many variables and more than one label' end
                ], lambda m: m is not null)) as violation
            from flagged where no_text or unknown_type or bad_matrix""",
        ),
        "german_text_required": with_(
            DEFS, "select survey_id, question_position, question_id from flagged where no_text"
        ),
        "flatten_input_single": flattened("question_type like 'input_single_%'"),
        "flatten_input_multiple": flattened("question_type like 'input_multiple_%'"),
        "flatten_matrix": flattened("question_type = 'matrix'"),
        "flatten_single_choice": flattened("question_type = 'single_choice'"),
        "flatten_multiple_choice": flattened("question_type = 'multiple_choice'"),
        "flatten_multiple_choice_other": flattened("question_type = 'multiple_choice_other'"),
        "flatten_scale": flattened("question_type = 'scale'"),
        "flatten_questions": flattened("true"),
        "default_columns": with_(
            VARIABLES,
            "select question_type, "
            + ", ".join(
                f"cast(count(*) filter (where {name} is null) as bigint) as no_{name}"
                for name in NULLABLE_METADATA
            )
            + """, cast(count(*) filter (where not is_other_boolean) as bigint) as not_other_boolean,
                cast(count(*) filter (where not is_other_text) as bigint) as not_other_text
            from variables group by 1""",
        ),
        "absolute_position": with_(
            DEFS, "select survey_id, question_id, question_position from base"
        ),
        "page_number": with_(
            DEFS,
            """select survey_id, question_id, page_id, cast(dense_rank() over (
                partition by survey_id order by page_id) as bigint) as page_number from base""",
        ),
        "join_question_text": """select l_orderkey as question_id, 'V' || l_linenumber as id,
            o_orderpriority as question_text
            from lineitem left join orders on l_orderkey = o_orderkey""",
        # names
        "name_single": with_(PART_METADATA, f"select {NAMES} from metadata where variable_count = 1"),
        "name_multi": with_(DOCUMENT_METADATA, f"select {NAMES} from metadata"),
        "name_multi_many_surveys": with_(
            PART_METADATA, f"select {NAMES} from metadata where variable_count > 1"
        ),
        "name_other": with_(
            PART_METADATA,
            f"""select {NAMES} from metadata where question_type = 'multiple_choice_other'
            and (is_other_boolean or is_other_text)""",
        ),
        "transliterate": f"select doc_id, md5({transliterated('text')}) as text_md5 from documents",
        "keep_original_id": with_(
            PART_METADATA,
            """select survey_id, question_position, original_id,
                case when variable_position = 1 then 'old_' || original_id else id end as id
            from metadata""",
        ),
        "group_variables": with_(
            DOCUMENT_METADATA,
            """select survey_id, question_id, id, row_number() over w as place,
                count(*) over (partition by survey_id, question_id) as variables_in_question
            from metadata
            window w as (partition by survey_id, question_id order by variable_position)""",
        ),
        "variables_per_question": with_(
            DOCUMENT_METADATA,
            "select survey_id, question_id, cast(count(*) as bigint) as var_count "
            "from metadata group by 1, 2",
        ),
        "duplicate_ids": """select cast(l_suppkey as varchar) as survey_id, 'V' || l_partkey as id,
            cast(count(*) as bigint) as "count" from lineitem group by 1, 2 having count(*) > 1""",
        "no_raw_names_left": with_(
            PART_METADATA,
            """select survey_id, question_position, original_id as id from metadata
            where question_position % 2 = 0""",
        ),
        # waves and structure
        "structure_diff": with_(
            f"{PART_METADATA}, {CHANGED}", multiset_difference("metadata", "changed")
        ),
        "structure_diff_copies": with_(
            """items as (select l_returnflag as survey_id, cast(l_suppkey as varchar) as original_id,
                cast(l_linenumber as varchar) as question_type, l_linestatus from lineitem),
            stored as (select * from items where l_linestatus = 'F'),
            new as (select * from items where l_linestatus = 'O')""",
            multiset_difference("stored", "new"),
        ),
        "next_wave": with_(
            cleaned, "select cast(coalesce(max(load_counter) + 1, 1) as bigint) as next_wave from cleaned"
        ),
        "next_wave_stored": with_(
            cleaned, "select cast(coalesce(max(load_counter) + 1, 1) as bigint) as next_wave from cleaned"
        ),
        "max_wave": with_(RAW, "select max(load_counter) as max_counter from raw"),
        # analytics
        "frequency_distribution": frequency("cleaned", "Q5", "where Q5 is not null", cleaned),
        "frequency_distribution_with_nulls": frequency("cleaned", "Q5", "", cleaned),
        "frequency_distribution_free_text": frequency(
            "cleaned", "Q7_rampe", "where Q7_rampe is not null", cleaned
        ),
        "frequency_distribution_flag": frequency("lineitem", "l_returnflag"),
        "frequency_distribution_event": frequency("events", "event_type"),
        "share_of_total": "select response, percentage from ("
        + frequency("orders", "o_orderpriority")
        + ")",
        "wave_trend": trend("Q2", "avg"),
        "wave_trend_sum": trend("Q4", "sum"),
        "wave_trend_min": trend("Q4", "min"),
        "wave_trend_max": trend("Q4", "max"),
        "wave_trend_count": trend("Q1_rechnung", "count"),
        "wave_trend_stddev": trend("Q4", "stddev_samp", rounded=True),
        "wave_trend_variance": trend("Q4", "var_samp", rounded=True),
        "item_distribution": """select l_quantity as score, cast(count(*) as bigint) as frequency
            from lineitem where l_quantity is not null group by 1""",
        "item_distribution_matrix": with_(
            cleaned,
            """select Q1_freundlich as score, cast(count(*) as bigint) as frequency
            from cleaned where Q1_freundlich is not null group by 1""",
        ),
        "frequency_all_variables": with_(
            f"""{cleaned}, answers as ({long_values}),
            counts as (select variable, response, count(*) as "count" from answers group by 1, 2)""",
            f"""select variable, response, cast("count" as bigint) as "count",
                {share('"count"', 'sum("count") over (partition by variable)')} as percentage
            from counts""",
        ),
        "trend_all_variables": with_(cleaned, trends),
        "count_questions": with_(
            PART_METADATA,
            """select survey_id, cast(count(distinct question_id) as bigint) as question_count
            from metadata group by 1""",
        ),
        "distinct_ordered": with_(
            VARIABLES,
            """select survey_id, id as column_name, array_to_string(list_filter(
                string_split(possible_values_labels, '|'),
                lambda l, i: list_position(string_split(possible_values_labels, '|'), l) = i), '|') as allowed
            from variables where possible_values_labels is not null""",
        ),
        "distinct_question_ids_sorted": with_(
            DOCUMENT_METADATA, "select distinct survey_id, question_id from metadata"
        ),
        "question_metadata": with_(
            PART_METADATA,
            """select id as variable_name, label as variable_label, question_text, question_type,
                possible_values_labels, scale_labels, range_min, range_max
            from metadata where question_id = 3""",
        ),
        "matrix_metadata": with_(
            PART_METADATA,
            """select id as variable_name, label as item_label, question_text, scale_labels,
                range_min, range_max from metadata where question_type = 'matrix'""",
        ),
        "find_variables": with_(
            PART_METADATA,
            """select id, question_text, possible_values_labels from metadata
            where question_type = 'single_choice'
            order by survey_id, question_position, group_id, variable_position limit 25""",
        ),
        # dictionary
        "dictionary_frame": with_(
            PART_METADATA,
            f"""select survey_id as "Survey Id", id as "Variable", coalesce(label, '') as "Label",
                question_text as "Question", question_id as "Question Id",
                question_type as "Question Type", schema_variable_type as "Data Type",
                {RANGE} as "Range",
                coalesce(replace(possible_values_labels, '|', '; '), '') as "Possible Values",
                coalesce(replace(scale_labels, '|', '; '), '') as "Scale Labels",
                question_position as "Question Position", variable_position as "Variable Position"
            from metadata""",
        ),
        "range_display": f"""select o_orderkey, {RANGE} as "range" from (
            select o_orderkey,
                case when o_orderkey % 3 <> 0 then floor(o_totalprice) end as range_min,
                case when o_orderkey % 5 <> 0 then o_custkey / 2 end as range_max from orders)""",
        "list_display": """select o_orderkey, case when o_orderkey % 7 = 0 then ''
            when o_orderkey % 2 = 0 then o_orderpriority || '; ' || o_orderstatus
            else o_orderpriority end as list from orders""",
        "dictionary_sections": with_(
            dictionary_lines(PART_METADATA), f"select {LINE_COLUMNS} from lines"
        ),
        "dictionary_sections_long": with_(
            dictionary_lines(DOCUMENT_METADATA), f"select {LINE_COLUMNS} from lines"
        ),
        "dictionary_overview": with_(
            DOCUMENT_METADATA,
            """select survey_id, cast(count(distinct question_id) as bigint) as total_questions,
                cast(count(*) as bigint) as total_variables from metadata group by 1""",
        ),
        # checks
        "build_contract": with_(
            PART_METADATA,
            """select survey_id, id as column_name, original_id as raw_name,
                case when possible_values_labels is not null then 'Enum'
                    else schema_variable_type end as type_name,
                true as nullable,
                array_to_string(list_filter(string_split(possible_values_labels, '|'), lambda l, i:
                    list_position(string_split(possible_values_labels, '|'), l) = i), '|') as allowed,
                range_min as minimum, range_max as maximum,
                case when possible_values_labels is not null then 'allowed_values'
                    when range_min is not null or range_max is not null then 'in_range'
                    else '' end as checks
            from metadata""",
        ),
        "validate_required_columns": checks("column_present"),
        "validate_types": checks("type"),
        "validate_not_null": checks("not_null"),
        "validate_allowed_values": checks("allowed_values"),
        "validate_range": checks("in_range"),
        "validate_collect_all": checks(),
        "validate_while_writing": checks(),
        "validate_metadata": metadata_checks(),
    }
