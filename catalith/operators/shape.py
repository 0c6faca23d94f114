"""Row-shape checks: each reads one row at a time and needs no shuffle.

Every rule exists as a list of checks, so that a load can run all rules of a
relation in one pass over its rows, and as a function that runs it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.binding import let
from catalith.functions.paths import RESERVED_CONCEPT, label_status, labels, leading, legal_label
from catalith.functions.text import blank, blank_text
from catalith.issues import Check, check_rows

# Fixed value: source, schema, table, column.
MAX_ANCHOR_LABELS = 4


def unknown_key_checks(body: str, allowed: tuple[str, ...]) -> list[Check]:
    extra = F.array_sort(F.array_except(F.map_keys(body), F.array(*[F.lit(k) for k in allowed])))
    return [("unknown_keys", F.size(extra) > 0, F.array_join(extra, ","))]


def unknown_keys(df: DataFrame, body: str, allowed: tuple[str, ...], object_type: str, key: Column) -> DataFrame:
    """Keys of the map column `body` outside `allowed`; one issue per row, names sorted."""
    return check_rows(df, object_type, key, unknown_key_checks(body, allowed))


def required_checks(types: dict[str, str], required: list[str]) -> list[Check]:
    return [
        ("required_fields", blank(F.col(c)) if types[c] == "string" else F.col(c).isNull(), F.lit(c)) for c in required
    ]


def required_fields(df: DataFrame, required: list[str], object_type: str, key: Column) -> DataFrame:
    """Required fields that are missing, or text that is blank. One issue per field."""
    return check_rows(df, object_type, key, required_checks(dict(df.dtypes), required))


def optional_text_checks(cols: list[str]) -> list[Check]:
    return [("optional_text", blank_text(F.col(c)), F.lit(c)) for c in cols]


def optional_text(df: DataFrame, cols: list[str], object_type: str, key: Column) -> DataFrame:
    """Optional text is NULL or has content; a blank is a second spelling of absent."""
    return check_rows(df, object_type, key, optional_text_checks(cols))


def default_flag(df: DataFrame, cols: list[str]) -> DataFrame:
    """An absent boolean means false."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in cols})


def label_checks(cols: list[str]) -> list[Check]:
    """Names that are not legal labels; a blank name belongs to another rule."""
    return [
        ("check_label", ~blank(F.col(c)) & (label_status(c) != "ok"), F.concat_ws(" ", label_status(c), F.lit(c)))
        for c in cols
    ]


def reserved_checks(col: str, reserved: tuple[str, ...]) -> list[Check]:
    return [("reserved_names", F.col(col).isin(*reserved), F.col(col))]


def reserved_names(df: DataFrame, col: str, reserved: tuple[str, ...], object_type: str, key: Column) -> DataFrame:
    return check_rows(df, object_type, key, reserved_checks(col, reserved))


def prefix_checks(reference: str, owner: str, n: int = 2) -> list[Check]:
    front = leading(reference, n)
    return [("prefix_agreement", ~front.eqNullSafe(F.col(owner)), F.concat_ws(" vs ", front, owner))]


def prefix_agreement(
    df: DataFrame, reference: str, owner: str, object_type: str, key: Column, n: int = 2
) -> DataFrame:
    """The first `n` labels of a reference must equal the owning folder's id."""
    return check_rows(df, object_type, key, prefix_checks(reference, owner, n))


def concept_name_reason(name: Column, prefix: Column, schema: Column) -> Column:
    """Why a concept name is not `[table[.column].]concept.leaf`; NULL if it is.

    `prefix` is the id of the folder, `schema` is NULL for a file at source
    level. The tests run in the order listed, so one defect gives one reason.
    """

    def reason(parts: Column) -> Column:
        n = F.size(parts)
        hits = F.size(F.filter(parts, lambda p: p == RESERVED_CONCEPT))
        place = F.array_position(parts, RESERVED_CONCEPT)
        anchor_labels = F.size(labels(prefix)) + n - 2
        return (
            F.when(blank(name), F.lit("empty"))
            .when(name.startswith("."), F.lit("leading_dot"))
            .when(name.endswith("."), F.lit("trailing_dot"))
            .when(name.contains(".."), F.lit("double_dot"))
            .when(~F.forall(parts, legal_label), F.lit("illegal_label"))
            .when(hits == 0, F.lit("no_concept_label"))
            .when(hits > 1, F.lit("concept_label_repeated"))
            .when(place == n, F.lit("concept_label_last"))
            .when(place != n - 1, F.lit("concept_label_misplaced"))
            .when((n > 2) & schema.isNull(), F.lit("anchor_in_source_file"))
            .when(anchor_labels > MAX_ANCHOR_LABELS, F.lit("anchor_too_deep"))
        )

    return let(labels(name), reason)


def concept_name_checks(name: str, prefix: str, schema: str) -> list[Check]:
    reason = concept_name_reason(F.col(name), F.col(prefix), F.col(schema))
    return [("concept_name_grammar", reason.isNotNull(), reason)]


def concept_name_grammar(df: DataFrame, name: str, prefix: str, schema: str, key: Column) -> DataFrame:
    return check_rows(df, "concepts", key, concept_name_checks(name, prefix, schema))


def ref_shape_checks(col: str, n: int = 3) -> list[Check]:
    c = F.col(col)
    good = let(labels(c), lambda p: (F.size(p) == n) & F.forall(p, legal_label))
    return [("ref_shape", c.isNotNull() & ~good, c)]


def ref_shape(df: DataFrame, col: str, object_type: str, key: Column, n: int = 3) -> DataFrame:
    """A pointer, when there is one, is exactly `n` legal labels."""
    return check_rows(df, object_type, key, ref_shape_checks(col, n))


def array_entry_check_list(arr: str, self_id: str) -> list[Check]:
    a = F.col(arr)
    twice = F.array_sort(F.array_distinct(F.filter(a, lambda x, i: F.array_position(a, x) < i + 1)))
    return [
        ("array_duplicate_entry", F.size(a) != F.size(F.array_distinct(a)), F.array_join(twice, ",")),
        ("array_self_reference", F.array_contains(a, F.col(self_id)), F.col(self_id)),
    ]


def array_entry_checks(df: DataFrame, arr: str, self_id: str, object_type: str, key: Column) -> DataFrame:
    """Entries of a link list: no entry twice, none equal to the row's own id."""
    return check_rows(df, object_type, key, array_entry_check_list(arr, self_id))
