"""DuckDB SQL that restates the flattening of the JSON documents.

Shares the list of columns and paths with the Spark code; the meaning of each
kind is written anew on DuckDB's JSON functions.
"""

from __future__ import annotations

from worklink.operators.fieldmap import FIELD_MAPS, Field, Path
from worklink.workload.bindings import with_clause

STRIP = r"'^\s+|\s+$', '', 'g'"


def clean(text: str) -> str:
    return f"nullif(regexp_replace({text}, {STRIP}), '')"


def phone(text: str) -> str:
    d = f"regexp_replace({text}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN {d} = '' THEN NULL WHEN length({d}) = 10 THEN '+91' || {d} "
        f"WHEN length({d}) = 12 AND {d} LIKE '91%' THEN '+' || {d} "
        f"WHEN length({d}) = 13 AND {d} LIKE '091%' THEN '+91' || substr({d}, 4) ELSE '+' || {d} END"
    )


def _name(root: str, keys: tuple[str, ...]) -> str:
    return "o_" + "_".join((root, *keys))


def _json(path: Path) -> str:
    return f"""json_extract({_name(path.root, path.keys[:-1])}, '$."{path.keys[-1]}"')"""


def _text(j: str) -> str:
    return f"CASE WHEN json_type({j}) = 'NULL' THEN NULL ELSE json_extract_string({j}, '$') END"


def _truthy(j: str) -> str:
    return (
        f"CASE json_type({j}) WHEN 'NULL' THEN false WHEN 'BOOLEAN' THEN ({j})::STRING = 'true' "
        f"WHEN 'VARCHAR' THEN json_extract_string({j}, '$') <> '' "
        f"WHEN 'ARRAY' THEN json_array_length({j}) > 0 WHEN 'OBJECT' THEN len(json_keys({j})) > 0 "
        f"ELSE coalesce(CAST({j} AS DOUBLE) <> 0, false) END"
    )


def _chosen(paths: tuple[Path, ...]) -> str:
    *head, last = [_json(p) for p in paths]
    whens = "".join(f"WHEN {_truthy(j)} THEN {j} " for j in head)
    return f"CASE {whens}ELSE {last} END" if head else last


def _chosen_text(paths: tuple[Path, ...]) -> str:
    whens = ""
    for p in paths[:-1]:
        if p.keys:
            whens += f"WHEN {_truthy(_json(p))} THEN {_text(_json(p))} "
        else:
            whens += f"WHEN {p.root} <> '' THEN {p.root} "
    last = paths[-1]
    tail = _text(_json(last)) if last.keys else last.root
    return f"CASE {whens}ELSE {tail} END" if whens else tail


def _items(j: str) -> str:
    return f"list_transform(json_extract({j}, '$[*]'), lambda x: {_text('x')})"


def _joined(items: str) -> str:
    stripped = f"list_transform({items}, lambda x: regexp_replace(x, {STRIP}))"
    return f"nullif(array_to_string(list_filter({stripped}, lambda x: x <> ''), '|'), '')"


def expression(field: Field) -> str:
    j = _chosen(field.paths) if all(p.keys for p in field.paths) else ""
    match field.kind:
        case "text":
            return clean(_chosen_text(field.paths))
        case "raw":
            return _chosen_text(field.paths)
        case "phone":
            return f"CASE WHEN {_truthy(j)} THEN {phone(_text(j))} END"
        case "bool":
            words = "('t', 'true', '1', 'yes')"
            return (
                f"CASE json_type({j}) WHEN 'NULL' THEN NULL "
                f"WHEN 'VARCHAR' THEN lower(regexp_replace({_text(j)}, {STRIP})) IN {words} "
                f"WHEN 'BOOLEAN' THEN {_truthy(j)} WHEN 'ARRAY' THEN {_truthy(j)} "
                f"WHEN 'OBJECT' THEN {_truthy(j)} "
                f"ELSE CASE WHEN json_type({j}) IS NOT NULL THEN {_truthy(j)} END END"
            )
        case "list":
            return (
                f"CASE WHEN json_type({j}) = 'ARRAY' THEN {_joined(_items(j))} "
                f"ELSE {clean(_text(j))} END"
            )
        case "elements":
            named = f"list_transform({_items(j)}, lambda x: coalesce(x, 'null'))"
            return (
                f"CASE WHEN json_type({j}) = 'ARRAY' THEN {_joined(named)} "
                f"WHEN json_type({j}) = 'VARCHAR' THEN {_joined(f'string_split({_text(j)}, chr(0) )')} END"
            ).replace(f"string_split({_text(j)}, chr(0) )", f"regexp_extract_all({_text(j)}, '.')")
        case "json":
            return f"CASE WHEN json_type({j}) <> 'NULL' THEN CAST({j} AS STRING) END"
        case "name":
            inner = f"""json_extract({j}, '$."name"')"""
            return clean(
                f"CASE WHEN json_type({j}) = 'OBJECT' THEN {_text(inner)} ELSE {_text(j)} END"
            )
        case "given":
            return f"CASE WHEN {_truthy(j)} THEN {clean(_text(j))} END"
    raise ValueError(field.kind)


def _parsed(text: str) -> str:
    return (
        f"CASE WHEN json_valid({text}) THEN CASE WHEN json_type({text}) = 'OBJECT' "
        f"THEN CAST({text} AS JSON) END END"
    )


def object_layers(source: str, fields: tuple[Field, ...]) -> str:
    """FROM clause with every nested object as a column."""
    found = {
        (p.root, p.keys[:d]) for f in fields for p in f.paths if p.keys for d in range(len(p.keys))
    }
    for depth in range(max(len(k) for _, k in found) + 1):
        cols = []
        for root, keys in sorted(o for o in found if len(o[1]) == depth):
            if not keys:
                expr = _parsed(root)
            else:
                j = _json(Path(root, keys))
                nested = _parsed(f"json_extract_string({j}, '$')")
                expr = f"CASE json_type({j}) WHEN 'OBJECT' THEN {j} WHEN 'VARCHAR' THEN {nested} END"
            cols.append(f"{expr} AS {_name(root, keys)}")
        source = f"(SELECT *, {', '.join(cols)} FROM {source}) AS l{depth}"
    return source


def unified_salary(end: str) -> str:
    nature = "lower(" + clean(_text(_json(Path("metadata", ("jobDetails", "natureOfJob"))))) + ")"
    by_name = {f.column: f for f in FIELD_MAPS["job_posting"]}
    return (
        f"CASE WHEN regexp_matches({nature}, 'internship|apprenticeship|trainee|stipend') "
        f"THEN {expression(by_name[f'stipend_{end}'])} "
        f"WHEN regexp_matches({nature}, 'task|piece|gig|freelance|daily wage|daily-wage') "
        f"THEN {expression(by_name[f'task_rate_{end}'])} "
        f"ELSE {expression(by_name[f'{end}_monthly_in_hand'])} END"
    )


def flatten_sql(table: str, binding: str, raw: list[str]) -> str:
    fields = FIELD_MAPS[table]
    cols = [*raw, *[f"{expression(f)} AS {f.column}" for f in fields]]
    if table == "job_posting":
        cols += [f"{unified_salary(e)} AS unified_salary_{e}" for e in ("min", "max")]
    return (
        f"{with_clause(binding)}\nSELECT " + ",\n  ".join(cols)
        + f"\nFROM {object_layers('b_' + binding, fields)}"
    )
