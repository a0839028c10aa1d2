"""Flattening and cleaning of the raw tables (PRJ-01..PRJ-07, RUL-01)."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.constants import STIPEND_WORDS, TASK_RATE_WORDS
from worklink.functions import variant as V
from worklink.functions.text import clean_bool, clean_phone, clean_str
from worklink.operators.fieldmap import FIELD_MAPS, Field, Path

# fixed values: the cleaned columns of the user table
TEXT_COLUMNS = ("name", "email", "role", "ban_reason", "image")
FLAG_COLUMNS = (
    "email_verified", "phone_number_verified", "banned", "terms_accepted", "privacy_accepted",
)


def _of_members(path: Path) -> str:
    return "_".join(["_obj", path.root, *path.keys])


class Members:
    """The members that fields read of every nested object.

    An object's members are read at once into a helper column, a struct of texts and, where more than the text of a
    value counts, variants. Keys that differ by case only, and the items of lists, go to structs of their own.
    """

    def __init__(self, fields: tuple[Field, ...]):
        self.fields, self.types = fields, {}
        self.lists = {f.paths[0] for f in fields if f.kind == "list" and len(f.paths) == 1}
        for f in fields:
            for i, p in enumerate(f.paths):
                text = f.kind in ("text", "raw") and i == len(f.paths) - 1 or f.kind == "list" and p in self.lists
                if p.keys and not (text and p in self.types):
                    self.types[p] = "string" if text else "variant"
                for depth in range(1, len(p.keys)):
                    self.types[Path(p.root, p.keys[:depth])] = "variant"
        self.objects = sorted({Path(p.root, p.keys[:-1]) for p in self.types}, key=lambda o: (len(o.keys), o.root, o.keys))
        self.structs: dict[Path, list[dict[str, str]]] = {o: [] for o in self.objects}
        self.place: dict[Path, int] = {}
        for p, kind in self.types.items():
            of_object, key = self.structs[Path(p.root, p.keys[:-1])], p.keys[-1]
            spelled = sum(key.lower() in (k.lower() for k in keys) for keys in of_object)
            if spelled == len(of_object):
                of_object.append({})
            of_object[spelled][key] = kind
            self.place[p] = spelled
        self.place_of_items: dict[Path, int] = {}
        for o in self.objects:
            lists = [p for p in self.lists if (p.root, p.keys[:-1]) == (o.root, o.keys)]
            if lists:
                self.place_of_items |= dict.fromkeys(lists, len(self.structs[o]))
                self.structs[o].append({p.keys[-1]: "array<string>" for p in sorted(lists, key=lambda p: p.keys)})

    def _struct(self, path: Path, place: int) -> Column:
        return F.col(f"{_of_members(Path(path.root, path.keys[:-1]))}_{place}").getField(path.keys[-1])

    def value(self, path: Path) -> Column:
        return self._struct(path, self.place[path])

    def items(self, path: Path) -> Column:
        return self._struct(path, self.place_of_items[path])

    def text(self, path: Path) -> Column:
        if not path.keys:
            return F.col(path.root).cast("string")
        return self.value(path) if self.types[path] == "string" else F.col(f"`_text_{'_'.join((path.root, *path.keys))}`")

    def chosen(self, paths: tuple[Path, ...], of: Callable[[Path], Column]) -> Column:
        """FN-11: what `of` gives of the first path with a truthy value, else of the last one."""
        *head, last = paths
        options = [
            F.when(V.truthy(self.value(p), self.text(p)) if p.keys else self.text(p) != "", of(p)) for p in head
        ]
        return F.coalesce(*options, of(last))

    def read(self, df: DataFrame) -> DataFrame:
        """The table with the helper columns; each document is parsed once."""
        for depth in range(len(self.objects[-1].keys) + 1):
            level = [o for o in self.objects if len(o.keys) == depth]
            found = {o: [f"{_of_members(o)}_{i}" for i in range(len(self.structs[o]))] for o in level}
            if depth:
                df = df.withColumns({c: V.members(self.value(o), keys) for o in level for c, keys in zip(found[o], self.structs[o])})
            # a text that holds an object is parsed in a step of its own, or else once for every use
            texts = {o: V.text_of(self.value(o)) if depth else F.col(o.root).cast("string") for o in level}
            df = df.withColumns({
                f"{_of_members(o)}_parsed": F.when(F.col(found[o][0]).isNull(), V.parsed(t)) if depth else V.parsed(t)
                for o, t in texts.items()})
            again = {}
            for o in level:
                parsed = F.col(f"{_of_members(o)}_parsed")
                for c, keys in zip(found[o], self.structs[o]):
                    inner = V.members_of_parsed(parsed, keys)
                    again[c] = F.coalesce(F.col(c), inner) if depth else inner
            df = df.withColumns(again).drop(*[f"{_of_members(o)}_parsed" for o in level])
        # several expressions use the text of a value and the choice between paths: each is a column, found once
        leaves = {p for f in self.fields for p in f.paths}
        df = df.withColumns({
            f"_text_{'_'.join((p.root, *p.keys))}": V.text_of(self.value(p))
            for p, kind in self.types.items() if kind == "variant" and p in leaves})
        return df.withColumns({
            f"_{what}_{f.column}": self.chosen(f.paths, of)
            for f in self.fields if len(f.paths) > 1
            for what, of in (("text", self.text), ("value", self.value))
            if what == "text" or f.kind not in ("text", "raw")})

    def of_field(self, field: Field) -> tuple[Column | None, Column]:
        """The value (null where only the text counts) and the text that a field takes."""
        if len(field.paths) > 1:
            return None if field.kind in ("text", "raw") else F.col(f"_value_{field.column}"), F.col(f"_text_{field.column}")
        only = field.paths[0]
        return self.value(only) if only.keys and self.types[only] == "variant" else None, self.text(only)


def _expr(members: Members, field: Field) -> Column:
    value, text = members.of_field(field)
    if field.kind == "text":
        return clean_str(text)
    if field.kind == "raw":
        return text
    if field.kind == "phone":
        return V.to_phone(value, text)
    if field.kind == "bool":
        return V.to_bool(value, text)
    if field.kind == "list":
        return V.to_list_text(value) if value is not None else V.list_text(members.items(field.paths[0]), text)
    if field.kind == "elements":
        return F.when(V.truthy(value, text), V.to_elements_text(value))
    if field.kind == "json":
        return V.to_json_text(value)
    if field.kind == "name":
        return clean_str(V.name_or_text(value, text))
    if field.kind == "given":
        return F.when(V.truthy(value, text), clean_str(text))
    raise ValueError(f"unknown field kind {field.kind}")


def flatten(df: DataFrame, fields: tuple[Field, ...],
            extra: Callable[[Members], dict[str, Column]] | None = None, columns: Collection[str] | None = None) -> DataFrame:
    """Raw columns plus one column per field, without a join.

    A field whose name a raw column already has comes out as `<name>_meta`. With `columns` only these fields come out, with
    the values they have among all; an object of which none of them reads a member is not opened.
    """
    if columns is not None:
        unknown = set(columns) - {f.column for f in fields}
        if unknown:
            raise ValueError(f"no such fields: {', '.join(sorted(unknown))}")
        fields = tuple(f for f in fields if f.column in columns)
    raw, members = df.columns, Members(fields)

    def name(column: str) -> str:
        return f"{column}_meta" if column in raw else column

    found = {f.column: _expr(members, f) for f in fields} | (extra(members) if extra else {})
    return members.read(df).select(
        *[F.col(c) for c in raw], *[e.alias(name(c)) for c, e in found.items()]
    )


def flatten_profile(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """PRJ-01: 94 columns of the seeker document, or some of them."""
    return flatten(df, FIELD_MAPS["profile"], columns=columns)


def flatten_organization(df: DataFrame) -> DataFrame:
    """PRJ-02: 7 columns of the organisation document."""
    return flatten(df, FIELD_MAPS["organization"])


def salary_basis(members: Members) -> dict[str, Column]:
    """RUL-01: salary bounds by nature of job."""
    nature = F.lower(clean_str(members.text(Path("metadata", ("jobDetails", "natureOfJob")))))

    def mentions(words: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a | b, [nature.contains(w) for w in words])

    by_name = {f.column: f for f in FIELD_MAPS["job_posting"]}

    def bound(end: str) -> Column:
        return (
            F.when(mentions(STIPEND_WORDS), _expr(members, by_name[f"stipend_{end}"]))
            .when(mentions(TASK_RATE_WORDS), _expr(members, by_name[f"task_rate_{end}"]))
            .otherwise(_expr(members, by_name[f"{end}_monthly_in_hand"]))
        )

    return {"unified_salary_min": bound("min"), "unified_salary_max": bound("max")}


def flatten_posting(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """PRJ-03: 87 columns of the posting document, or some of its fields (without the salary bounds by nature of job)."""
    return flatten(df, FIELD_MAPS["job_posting"], salary_basis if columns is None else None, columns)


def flatten_application(df: DataFrame) -> DataFrame:
    """PRJ-04: 58 columns of the application's three documents."""
    return flatten(df, FIELD_MAPS["job_application"])


def clean_user(df: DataFrame) -> DataFrame:
    """PRJ-05: cleans the columns that are present, in place."""
    cleaners = (
        {c: clean_str for c in TEXT_COLUMNS}
        | {c: clean_bool for c in FLAG_COLUMNS}
        | {"phone_number": clean_phone}
    )
    return df.withColumns({c: f(F.col(c)) for c, f in cleaners.items() if c in df.columns})


def clean_member(df: DataFrame) -> DataFrame:
    """PRJ-06."""
    return df.withColumn("role", clean_str(F.col("role")))


def location_columns(v: Column, prefix: str) -> list[Column]:
    """PRJ-07: six columns of a location object."""
    gps = V.get(v, "gps")
    city = V.first_truthy(V.get(v, "city"), V.get(v, "tag"))
    texts = {"city": clean_str(V.text_of(city))} | {
        k: clean_str(V.get_text(v, k)) for k in ("state", "address", "country")
    }
    point = {k: V.get_text(gps, k) for k in ("lat", "lng")}
    return [e.alias(f"{prefix}_{k}") for k, e in (texts | point).items()]
