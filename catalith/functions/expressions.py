"""Lexical facts about SQL expression text, as column expressions.

One regular expression cuts the text into tokens, so literals, comments and
quoted names cannot be mistaken for references. Everything else is an array
function over those tokens: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.binding import let

# Quantifiers of groups are possessive: Java then runs them as loops, so that a text of
# any length is cut without using up the stack.
_NAME = r'(?:[\p{L}_][\p{L}\p{N}_$]*+|"[^"]*+")'
_SIGN = r"(?:\+|-(?!-))"
_CALL_OR_CHAIN = rf"{_NAME}(?:\s*+\.\s*+{_NAME})*+(?:\s*+\()?"  # name chain, or a call with its bracket
_TOKEN = (
    r"(?s)[eE]'(?:[^'\\]++|\\.|'')*+'"  # literal with escapes
    r"|'[^']*+(?:''[^']*+)*+'"  # literal
    # A dollar-quoted literal or a comment that is never closed takes the rest, as it would in a database: so
    # the end is looked for once, however many openings there are.
    r"|\$(?<tag>(?:[\p{L}_][\p{L}\p{N}_]*+)?)\$(?:[^$]++|\$(?!\k<tag>\$))*+(?:\$\k<tag>\$|\z)"
    r"|--[^\n]*+|/\*(?:[^*]++|\*(?!/))*+(?:\*/|\z)"
    rf"|{_CALL_OR_CHAIN}"
    r"|[0-9]++(?:\.[0-9]*+)?(?:[eE][+-]?[0-9]++)?|\.[0-9]++"  # number
    r"|[(),;\[\]]"
    # An operator may end in a sign only if it holds one of ~ ! @ # % ^ & | ` ?, else the sign belongs to
    # the operand. Each run of operator characters is looked at from its start only.
    r"|(?<![-+*/<>=~!@#%^&|`?:.])(?=(?:(?!--|/\*)[-+*/<>=:.])*+[~!@#%^&|`?])(?:(?!--|/\*)[-+*/<>=~!@#%^&|`?:.])++"
    rf"|(?:(?!/\*)[*/<>=:.]|(?<![-+]){_SIGN}++(?=[*<>=:.]|/(?!\*)))++"
    rf"|{_SIGN}|[~!@#%^&|`?]"
)
_IS_CHAIN = rf"\A{_NAME}(?:\s*+\.\s*+{_NAME})++\z"
_CHAIN = rf"{_NAME}(?:\s*+\.\s*+{_NAME})"
# White space, a token that starts no name, or a literal with escapes.
_NO_NAME = rf"""\s++|(?![\p{{L}}_"])(?:{_TOKEN}|\S)|(?s:[eE]'(?:[^'\\]++|\\.|'')*+')"""
# The next dotted chain, in group 2, behind all tokens that are none; group 1 is the tag of a dollar quote.
_CHAINS = rf"""\G(?:{_NO_NAME}|{_NAME}(?!\s*+\.\s*+{_NAME})|{_CHAIN}++\s*+\(|"(?![^"]*+"))*+({_CHAIN}++)"""
_IS_BARE = rf"\A{_NAME}\z"

# Functions whose result changes between runs, and the context
# keywords among them that need no brackets.
VOLATILE_FUNCTIONS = (
    "now", "current_timestamp", "current_date", "current_time", "localtime", "localtimestamp",
    "clock_timestamp", "statement_timestamp", "transaction_timestamp", "timeofday", "age",
    "random", "gen_random_uuid", "uuid_generate_v4", "setseed",
    "nextval", "currval", "lastval", "setval",
    "current_user", "session_user", "current_role", "current_schema", "current_database",
    "current_catalog", "current_setting", "version", "txid_current", "pg_backend_pid",
    "pg_current_xact_id", "inet_client_addr", "pg_sleep",
)
CONTEXT_KEYWORDS = (
    "current_timestamp", "current_date", "current_time", "localtime", "localtimestamp",
    "current_user", "session_user", "current_role", "current_schema", "current_catalog",
    "current_database",
)

# Operators and words that make an expression a predicate.
PREDICATE_OPERATORS = ("=", "<>", "!=", "<", "<=", ">", ">=", "~", "~*", "!~", "!~*", "~~", "~~*", "!~~", "!~~*")
PREDICATE_WORDS = ("and", "or", "not", "in", "is", "like", "ilike", "between", "similar", "isnull", "notnull")

# Words that may stand alone in an expression without naming a column.
SQL_WORDS = (
    "all", "and", "any", "array", "as", "asc", "at", "between", "both", "by", "case", "cast", "collate",
    "cross", "desc", "distinct", "else", "end", "escape", "except", "exists", "false", "filter",
    "following", "for", "from", "full", "group", "having", "ilike", "in", "inner", "intersect", "interval",
    "is", "isnull", "join", "leading", "left", "like", "limit", "natural", "not", "notnull", "null",
    "nulls", "of", "offset", "on", "or", "order", "outer", "over", "partition", "placing", "preceding",
    "range", "right", "row", "rows", "select", "similar", "some", "symmetric", "then", "to", "trailing",
    "true", "unbounded", "union", "unknown", "using", "when", "where", "with", "within", "without",
    "insert", "update", "delete", "merge", "into", "values", "set", "create", "drop", "alter", "grant",
    "truncate", "table",
)

# Those of them that are not reserved, so that they do name a column where a value is due.
SOFT_WORDS = (
    "at", "by", "delete", "drop", "escape", "filter", "following", "insert", "interval", "merge", "nulls", "of", "over",
    "partition", "preceding", "range", "row", "rows", "set", "truncate", "unbounded", "unknown", "update", "values",
    "within", "without", "alter",
)
# What a value may stand behind, and what may follow one.
BEFORE_VALUE = ("", "(", "[", ",", "and", "or", "not", "when", "then", "else", "case", "between", "like", "ilike", "where", "on", "having")
AFTER_VALUE = (
    "", ")", "]", ",", "::", "and", "or", "is", "in", "like", "ilike", "between", "not", "isnull", "notnull", "when", "then",
    "else", "end", "collate", "asc", "desc",
)
_OPERATOR = r"\A[-+*/<>=~!@#%^&|`?]++\z"

# Words that name no column only next to each other.
WORD_PAIRS = (
    "time zone", "double precision", "character varying", "char varying", "bit varying", "nulls first",
    "nulls last", "current row",
)

# The label reported for each statement verb that opens a text.
STATEMENT_LABELS = {
    "update": "UPDATE statement",
    "insert": "INSERT statement",
    "delete": "DELETE statement",
    "merge": "MERGE statement",
    "create": "CREATE statement",
    "drop": "DROP statement",
    "alter": "ALTER statement",
    "grant": "GRANT statement",
    "truncate": "TRUNCATE statement",
}
OTHER_COMMANDS = (
    "analyze", "begin", "call", "commit", "copy", "execute", "explain", "prepare", "revoke", "rollback",
    "set", "show", "vacuum",
)
SET_OPERATION_LABELS = {
    "intersect": "INTERSECT set-operation",
    "except": "EXCEPT set-operation",
    "union": "UNION set-operation",
}

# What a label can hang on: without one of these tokens an expression is plain.
NAVIGATION_WORDS = (";", "select", "with", "join", "from", *STATEMENT_LABELS, *OTHER_COMMANDS, *SET_OPERATION_LABELS)
# What changes the depth, but for the bracket of a call.
_DEPTH_TOKENS = ("(", "[", ")", "]", "case", "end")
HARD_WORDS = tuple(w for w in (*SQL_WORDS, *CONTEXT_KEYWORDS) if w not in SOFT_WORDS)
REFERENCE_PARTS = 4
# A text all of whose names are references of that many parts, calls, or words that never name a column. Only
# plain names are known here; a reference with a bracket behind it is a call, and as good.
_PLAIN = r"[a-zA-Z_][a-zA-Z0-9_$]*+"
_ALL_QUALIFIED = (
    rf"\A(?:{_PLAIN}(?:\.{_PLAIN}){{{REFERENCE_PARTS - 1}}}+(?![\p{{L}}\p{{N}}]|\s*+\.)|{_NO_NAME}"
    rf"|(?i:{'|'.join(HARD_WORDS)})(?![\p{{L}}\p{{N}}_$]|\s*+\.)|{_CHAIN}*+\s*+\()*+\z"
)


def all_tokens(expr: Column) -> Column:
    """Every token, white space and comments included: joined again they give the text."""
    return F.regexp_extract_all(expr, F.lit(rf"({_TOKEN}|\s+|.)"), F.lit(1))


def tokens(expr: Column) -> Column:
    """The tokens that mean something: no white space, no comments."""
    found = F.regexp_extract_all(expr, F.lit(rf"({_TOKEN}|\S)"), F.lit(1))
    return F.filter(found, lambda t: ~(t.startswith("--") | t.startswith("/*")))


def plain_reference(token: Column) -> Column:
    """A name chain without its quotes and inner white space."""
    bare = F.regexp_replace(F.regexp_replace(token, r"\s*\.\s*", "."), '"', "")
    return F.when(token.rlike(r'[\s"]'), bare).otherwise(token)


def reference_tokens(toks: Column) -> Column:
    """Dotted references in text order, duplicates kept. A NULL text has NULL tokens and references."""
    return F.transform(F.filter(toks, lambda t: t.contains(".") & t.rlike(_IS_CHAIN)), plain_reference)


def column_references(expr: Column) -> Column:
    """The same from the text: the expression that cuts it passes over all other tokens by itself."""
    return F.transform(F.regexp_extract_all(expr, F.lit(_CHAINS), F.lit(2)), plain_reference)


def _n_parts(reference: Column) -> Column:
    return F.length(reference) - F.length(F.replace(reference, F.lit("."), F.lit(""))) + 1


def bare_names(expr: Column) -> Column:
    """One-part names that are neither SQL words nor stand where only a type, field or collation can."""
    return let(tokens(expr), bare_name_tokens)


def bare_name_tokens(toks: Column) -> Column:
    # Neighbours are looked at only around the few names that are not plainly words of the language.
    def names_a_column(t: Column, i: Column) -> Column:
        around = [F.lower(F.get(toks, i + k)) for k in (-2, -1, 0, 1)]
        return t.rlike(_IS_BARE) & ~F.lower(t).isin(*HARD_WORDS) & let(F.array(*around), _stands_for_a_column)

    return F.transform(let(toks, lambda toks: F.filter(toks, names_a_column)), plain_reference)


def _stands_for_a_column(around: Column) -> Column:
    """By the lower-case tokens two before, before, at, and behind the place."""
    earlier, word = F.get(around, F.lit(0)), F.get(around, F.lit(2))
    before, after = (F.coalesce(F.get(around, F.lit(k)), F.lit("")) for k in (1, 3))
    # By position: `range > 1` compares a column, `order by x range between` does not.
    starts = (before.isin(*BEFORE_VALUE) | before.endswith("(") | before.rlike(_OPERATOR)) & ~before.rlike(r"\Aover\s*\(\z")
    ends = after.isin(*AFTER_VALUE) | after.rlike(_OPERATOR) | after.rlike(r"\Ain\s*\(\z")
    soft = word.isin(*SOFT_WORDS) & starts & ends
    no_column = (
        (word.isin(*SQL_WORDS, *CONTEXT_KEYWORDS) & ~soft)
        | before.isin("::", "as", "collate")  # a type, or a collation
        | before.rlike(r"\Aextract\s*\(\z")  # a field
        | after.startswith("'")  # the type of a literal
        | (before.startswith("'") & (earlier == "interval"))  # an interval's field
        | (F.concat_ws(" ", before, word).isin(*WORD_PAIRS))
        | (F.concat_ws(" ", word, after).isin(*WORD_PAIRS))
    )
    return ~F.coalesce(no_column, F.lit(False))


def badly_qualified(expr: Column) -> Column:
    """References, bare names included, that do not have exactly four parts. Most texts need not be cut up to see that there are none."""
    none = F.array().cast("array<string>")
    return F.when(all_qualified(expr), none).otherwise(let(tokens(expr), badly_qualified_tokens))


def all_qualified(expr: Column) -> Column:
    """True only if nothing is badly qualified; texts with a name that needs a look at its neighbours are not told from bad ones."""
    return expr.rlike(_ALL_QUALIFIED)


def badly_qualified_tokens(toks: Column) -> Column:
    return let(toks, lambda toks: badly_qualified_of(reference_tokens(toks), toks))


def badly_qualified_of(references: Column, toks: Column) -> Column:
    """The same where the references are at hand."""
    return F.concat(F.filter(references, lambda r: _n_parts(r) != REFERENCE_PARTS), bare_name_tokens(toks))


def tables_referenced(expr: Column) -> Column:
    """Sorted distinct three-label prefixes of the references; empty for a NULL expression."""
    return tables_of(column_references(expr))


def tables_of(references: Column) -> Column:
    tables = F.transform(references, lambda r: F.substring_index(r, ".", 3))
    empty = F.array().cast("array<string>")
    return F.coalesce(F.sort_array(F.array_distinct(tables)), empty)


def _word(token: Column) -> Column:
    """A token without the bracket of a call; most tokens carry none and need no regular expression."""
    return F.when(token.endswith("("), F.regexp_replace(token, r"\s*\(\z", "")).otherwise(token)


def volatile_functions(expr: Column) -> Column:
    """Sorted distinct denylisted names used as a call or as a bare context keyword."""
    return volatile_tokens(tokens(expr))


def volatile_tokens(toks: Column) -> Column:
    def found(toks: Column) -> Column:
        calls = F.transform(
            F.filter(toks, lambda t: t.endswith("(") & t.rlike(r'[\w"]\s*+\(\z')),
            lambda t: F.regexp_extract(t, r'(\w+)"?\s*+\(\z', 1),
        )
        denied = F.filter(calls, lambda n: n.isin(*VOLATILE_FUNCTIONS))
        words = F.filter(toks, lambda t: t.isin(*CONTEXT_KEYWORDS))
        return F.array_sort(F.array_distinct(F.concat(denied, words)))

    return let(F.transform(toks, F.lower), found)


def navigation_kind(expr: Column) -> Column:
    """Label of the outermost statement or row-navigating construct, NULL for a plain expression."""
    return navigation_of(tokens(expr))


def navigation_of(toks: Column) -> Column:
    def label(raw: Column) -> Column:
        return let(
            F.transform(raw, _word),
            lambda toks: F.when(F.exists(toks, lambda t: t.isin(*NAVIGATION_WORDS)), _label_of(raw, toks)),
        )

    return let(F.transform(toks, F.lower), label)


def _label_of(raw: Column, toks: Column) -> Column:
    first = F.get(toks, F.lit(0))
    # A semicolon that is not the last token starts a second statement.
    second_statement = F.exists(F.slice(toks, F.lit(1), F.greatest(F.size(toks) - 1, F.lit(0))), lambda t: t == ";")
    # A query right behind an opening bracket.
    inner_query = F.exists(
        F.transform(
            toks,
            lambda t, i: t.isin("select", "with") & (i > 0) & F.coalesce(F.get(raw, i - 1).endswith("("), F.lit(False)),
        ),
        lambda b: b,
    )

    def has(word: str) -> Column:
        return F.array_contains(toks, word)

    label = F.when(second_statement, F.lit("multiple statements"))
    for word, text in SET_OPERATION_LABELS.items():
        label = label.when((first == "select") & has(word), F.lit(text))
    label = label.when(first.isin("select", "with"), F.lit("SELECT statement"))
    for word, text in STATEMENT_LABELS.items():
        label = label.when(first == word, F.lit(text))
    label = label.when(first.isin(*OTHER_COMMANDS), F.lit("SQL command/statement"))
    label = label.when(inner_query, F.lit("subquery"))
    for word, text in SET_OPERATION_LABELS.items():
        label = label.when(has(word), F.lit(text))
    return (
        label.when(has("join"), F.lit("JOIN"))
        .when(has("select"), F.lit("SELECT statement"))
        .when(first == "from", F.lit("FROM clause"))
    )


def is_predicate(expr: Column) -> Column:
    """The outermost operator yields a boolean; redundant outer brackets are looked through.

    One pass over the tokens keeps the bracket depth, the smallest depth at
    which anything stands, and whether a predicate operator stands there, so
    any nesting depth is handled.
    """
    return predicate_of(tokens(expr))


def predicate_of(toks: Column) -> Column:
    """Without brackets every token stands at the same depth; with them the depth is counted."""

    def look(raw: Column) -> Column:
        nested = F.exists(raw, lambda t: t.endswith("(") | t.isin(*_DEPTH_TOKENS))
        flat = F.exists(raw, lambda t: t.isin(*PREDICATE_OPERATORS, *PREDICATE_WORDS))
        return F.when(nested, _predicate_at_top(raw)).otherwise(flat)

    return let(F.transform(toks, F.lower), look)


def _predicate_at_top(raw: Column) -> Column:
    """For lower-case tokens."""
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(1 << 30).alias("top"),
        F.lit(False).alias("found"),
    )

    def seen(t: Column) -> Column:
        word = _word(t)
        opens = t.endswith("(") | t.isin("[", "case")
        return F.struct(
            F.when(opens, 1).when(t.isin(")", "]", "end"), -1).otherwise(0).alias("step"),
            (~t.isin(")", "]", "end", "(")).alias("stands"),
            word.isin(*PREDICATE_OPERATORS, *PREDICATE_WORDS).alias("hit"),
        )

    def step(state: Column, token: Column) -> Column:
        here, top = state["depth"], state["top"]
        found = (
            F.when(~token["stands"] | (here > top), state["found"])
            .when(here < top, token["hit"])
            .otherwise(state["found"] | token["hit"])
        )
        return F.struct(
            (here + token["step"]).alias("depth"),
            F.when(token["stands"], F.least(here, top)).otherwise(top).alias("top"),
            found.alias("found"),
        )

    return F.aggregate(F.transform(raw, seen), start, step, lambda s: s["found"])


def translated(expr: Column, physical_tables: Column) -> Column:
    """Rewrite four-part references with `physical_tables` (map table id -> physical name)."""

    def swap(token: Column) -> Column:
        ref = plain_reference(token)
        target = F.try_element_at(physical_tables, F.substring_index(ref, ".", 3))
        is_reference = token.contains(".") & token.rlike(_IS_CHAIN) & (F.size(F.split(ref, r"\.")) == REFERENCE_PARTS)
        return F.when(
            is_reference & target.isNotNull(),
            F.concat(target, F.lit("."), F.regexp_extract(token, rf"({_NAME})\z", 1)),
        ).otherwise(token)

    return F.array_join(F.transform(all_tokens(expr), swap), "")
