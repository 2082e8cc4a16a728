"""The rule language: what a rule may call, and what each call is in Spark SQL.

Packs are written in Spark SQL, so these tables are for people who move rules over and for the
allow-list gate. `{0}`, `{1}`, `{2}` stand for the arguments. Lambdas take `x`.
"""

from __future__ import annotations

# The functions of the first notation, and the Spark SQL that computes each.
EXPRESSION_FUNCTIONS = {
    "abs": "abs({0})",
    "floor": "floor({0})",
    "ceil": "ceil({0})",
    "round": "round({0})",
    "trunc": "cast({0} as bigint)",
    "min": "array_min({0})",
    "max": "array_max({0})",
    "sum": "aggregate({0}, 0D, (a, x) -> a + x)",
    "avg": "aggregate({0}, 0D, (a, x) -> a + x) / size({0})",
    "median": "(get(array_sort({0}), cast((size({0}) - 1) / 2 as int)) + get(array_sort({0}), cast(size({0}) / 2 as int))) / 2",
    "mode": "element_at(array_sort(transform(array_distinct({0}), v -> struct(-size(filter({0}, x -> x = v)), v))), 1).v",
    "rand": "cast(floor(rand() * {0}) as bigint)",
    "len": "size({0})",
    "upper": "upper({0})",
    "lower": "lower({0})",
    "trim": "trim({0})",
    "contains": "array_contains({0}, {1})",
    "startsWith": "startswith({0}, {1})",
    "endsWith": "endswith({0}, {1})",
    "matches": "{0} rlike {1}",
    "extract": "regexp_extract_all({0}, {1}, 0)",
    "split": "split({0}, {1})",
    "fuzzyMatch": "1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}))",
    "map": "transform({0}, x -> {1})",
    "filter": "filter({0}, x -> {1})",
    "some": "exists({0}, x -> {1})",
    "all": "forall({0}, x -> {1})",
    "one": "size(filter({0}, x -> {1})) = 1",
    "none": "not exists({0}, x -> {1})",
    "count": "size(filter({0}, x -> {1}))",
    "flatMap": "flatten(transform({0}, x -> {1}))",
    "keys": "map_keys({0})",
    "values": "map_values({0})",
    "merge": "map_concat({0}, {1})",
    "mergeDeep": "map_zip_with({0}, {1}, (k, a, b) -> coalesce(map_concat(a, b), a, b))",
    "d": "try_to_date({0}, 'yyyy-MM-dd')",
    "duration": "cast({0} as interval day to second)",
    "string": "cast({0} as string)",
    "number": "try_cast({0} as double)",
    "bool": "try_cast({0} as boolean)",
    "type": "typeof({0})",
    "isNumeric": "try_cast({0} as double) is not null",
}

# The date methods of the first notation. `{0}` is the date.
DATE_METHODS = {
    "year": "year({0})",
    "month": "month({0})",
    "day": "day({0})",
    "weekday": "weekday({0}) + 1",
    "hour": "hour({0})",
    "minute": "minute({0})",
    "second": "second({0})",
    "dayOfYear": "dayofyear({0})",
    "quarter": "quarter({0})",
    "timestamp": "unix_millis(cast({0} as timestamp))",
    "set": "make_date({1}, month({0}), day({0}))",
    "add": "date_add({0}, {1})",
    "sub": "date_sub({0}, {1})",
    "isBefore": "{0} < {1}",
    "isAfter": "{0} > {1}",
    "isSame": "{0} = {1}",
    "isSameOrBefore": "{0} <= {1}",
    "isSameOrAfter": "{0} >= {1}",
    "diff": "datediff({0}, {1})",
    "startOf": "cast(date_trunc({1}, {0}) as date)",
    "endOf": "last_day({0})",
    "tz": "convert_timezone('UTC', {1}, cast({0} as timestamp_ntz))",
    "offsetName": "date_format(cast({0} as timestamp), 'VV')",
    "isValid": "{0} is not null",
    "isToday": "{0} = current_date()",
    "isYesterday": "{0} = date_sub(current_date(), 1)",
    "isTomorrow": "{0} = date_add(current_date(), 1)",
    "isLeapYear": "day(last_day(make_date(year({0}), 2, 1))) = 29",
    "format": "date_format({0}, 'yyyy-MM-dd')",
}

# The built-in functions of the second notation, by group. Ranges are structs
# (lo, hi) with both ends included.
FEEL_FUNCTIONS = {
    # boolean
    "not": "not {0}",
    "is defined": "{0} is not null",
    "get or else": "coalesce({0}, {1})",
    "assert": "if({1}, {0}, raise_error('assertion failed'))",
    # string
    "substring": "substring({0}, {1}, {2})",
    "string length": "length({0})",
    "upper case": "upper({0})",
    "lower case": "lower({0})",
    "substring before": "if(locate({1}, {0}) > 0, substring_index({0}, {1}, 1), '')",
    "substring after": "if(locate({1}, {0}) > 0, substring({0}, locate({1}, {0}) + length({1})), '')",
    "contains": "contains({0}, {1})",
    "starts with": "startswith({0}, {1})",
    "ends with": "endswith({0}, {1})",
    "matches": "{0} rlike {1}",
    "replace": "regexp_replace({0}, {1}, {2})",
    "split": "split({0}, {1})",
    "extract": "regexp_extract_all({0}, {1}, 0)",
    "trim": "trim({0})",
    "uuid": "uuid()",
    "to base64": "base64({0})",
    "from base64": "decode(unbase64({0}), 'UTF-8')",
    "is blank": "trim({0}) = ''",
    "string join": "array_join({0}, {1})",
    # numeric
    "decimal": "bround({0}, {1})",
    "floor": "floor({0})",
    "ceiling": "ceil({0})",
    "round up": "sign({0}) * ceil(abs({0}) * pow(10, {1})) / pow(10, {1})",
    "round down": "sign({0}) * floor(abs({0}) * pow(10, {1})) / pow(10, {1})",
    "round half up": "round({0}, {1})",
    "round half down": "sign({0}) * ceil(abs({0}) * pow(10, {1}) - 0.5) / pow(10, {1})",
    "abs": "abs({0})",
    "modulo": "pmod({0}, {1})",
    "sqrt": "sqrt({0})",
    "log": "ln({0})",
    "exp": "exp({0})",
    "odd": "pmod({0}, 2) = 1",
    "even": "pmod({0}, 2) = 0",
    "random number": "rand()",
    # list
    "list contains": "array_contains({0}, {1})",
    "count": "size({0})",
    "min": "array_min({0})",
    "max": "array_max({0})",
    "sum": "aggregate({0}, 0D, (a, x) -> a + x)",
    "product": "aggregate({0}, 1D, (a, x) -> a * x)",
    "mean": "aggregate({0}, 0D, (a, x) -> a + x) / size({0})",
    "median": "(get(array_sort({0}), cast((size({0}) - 1) / 2 as int)) + get(array_sort({0}), cast(size({0}) / 2 as int))) / 2",
    "stddev": "sqrt(aggregate({0}, 0D, (a, x) -> a + pow(x - aggregate({0}, 0D, (s, y) -> s + y) / size({0}), 2)) / (size({0}) - 1))",
    "mode": "array_sort(filter(array_distinct({0}), v -> size(filter({0}, x -> x = v)) = array_max(transform({0}, w -> size(filter({0}, x -> x = w))))))",
    "all": "forall({0}, x -> x)",
    "any": "exists({0}, x -> x)",
    "sublist": "slice({0}, {1}, {2})",
    "append": "array_append({0}, {1})",
    "concatenate": "concat({0}, {1})",
    "insert before": "array_insert({0}, {1}, {2})",
    "remove": "filter({0}, (x, i) -> i <> {1} - 1)",
    "reverse": "reverse({0})",
    "index of": "filter(sequence(1, size({0})), i -> element_at({0}, i) = {1})",
    "union": "array_union({0}, {1})",
    "distinct values": "array_distinct({0})",
    "duplicate values": "filter(array_distinct({0}), v -> size(filter({0}, x -> x = v)) > 1)",
    "flatten": "flatten({0})",
    "sort": "array_sort({0})",
    "partition": "transform(sequence(1, size({0}), {1}), i -> slice({0}, i, {1}))",
    "is empty": "size({0}) = 0",
    # context
    "get value": "try_element_at({0}, {1})",
    "get entries": "map_entries({0})",
    "context put": "map_concat(map_filter({0}, (k, v) -> k <> {1}), map({1}, {2}))",
    "context merge": "map_concat(map_filter({0}, (k, v) -> not array_contains(map_keys({1}), k)), {1})",
    "context": "map_from_entries({0})",
    # temporal
    "now": "current_timestamp()",
    "today": "current_date()",
    "day of week": "date_format({0}, 'EEEE')",
    "day of year": "dayofyear({0})",
    "week of year": "weekofyear({0})",
    "month of year": "date_format({0}, 'MMMM')",
    "last day of month": "last_day({0})",
    # range
    "before": "{0}.hi < {1}.lo",
    "after": "{0}.lo > {1}.hi",
    "meets": "{0}.hi = {1}.lo",
    "met by": "{0}.lo = {1}.hi",
    "overlaps": "{0}.lo <= {1}.hi and {0}.hi >= {1}.lo",
    "overlaps before": "{0}.lo < {1}.lo and {0}.hi >= {1}.lo and {0}.hi <= {1}.hi",
    "overlaps after": "{0}.lo >= {1}.lo and {0}.lo <= {1}.hi and {0}.hi > {1}.hi",
    "finishes": "{0}.hi = {1}.hi and {0}.lo >= {1}.lo",
    "finished by": "{0}.hi = {1}.hi and {0}.lo <= {1}.lo",
    "includes": "{0}.lo <= {1}.lo and {0}.hi >= {1}.hi",
    "during": "{0}.lo >= {1}.lo and {0}.hi <= {1}.hi",
    "starts": "{0}.lo = {1}.lo and {0}.hi <= {1}.hi",
    "started by": "{0}.lo = {1}.lo and {0}.hi >= {1}.hi",
    "coincides": "{0}.lo = {1}.lo and {0}.hi = {1}.hi",
    # conversion
    "string": "cast({0} as string)",
    "number": "try_cast({0} as double)",
    "date": "try_to_date({0}, 'yyyy-MM-dd')",
    "time": "date_format(try_to_timestamp({0}, 'HH:mm:ss'), 'HH:mm:ss')",
    "date and time": "try_to_timestamp({0})",
    "duration": "cast({0} as interval day to second)",
    "years and months duration": "cast(months_between({1}, {0}) as int)",
    "to json": "to_json({0})",
    "from json": "from_json({0}, {1})",
}

# The operators of the two notations and the Spark SQL that computes each. Logic is
# three-valued in Spark SQL as it stands: a missing operand decides nothing.
OPERATORS = {
    "and": "{0} and {1}",
    "or": "{0} or {1}",
    "not": "not {0}",
    "==": "{0} = {1}",
    "=": "{0} = {1}",
    "!=": "{0} <> {1}",
    "<": "{0} < {1}",
    ">": "{0} > {1}",
    "<=": "{0} <= {1}",
    ">=": "{0} >= {1}",
    "in": "array_contains({1}, {0})",
    "not in": "not array_contains({1}, {0})",
    "in [a..b]": "{0} between {1} and {2}",
    "in (a..b)": "{0} > {1} and {0} < {2}",
    "+": "{0} + {1}",
    "-": "{0} - {1}",
    "*": "{0} * {1}",
    "/": "try_divide({0}, {1})",
    "%": "{0} % {1}",
    "^": "pow({0}, {1})",
    "**": "pow({0}, {1})",
    "? :": "case when {0} then {1} else {2} end",
    "if then else": "case when {0} then {1} else {2} end",
    "??": "coalesce({0}, {1})",
    "x[n] from 0": "get({0}, {1})",
    "x[n] from 1": "try_element_at({0}, {1})",
    "x[test]": "filter({0}, x -> {1})",
    "[a..b]": "sequence({0}, {1})",
    "for in return": "transform(sequence({0}, {1}), x -> {2})",
    "[a, b]": "array({0}, {1})",
    ".days": "datediff({0}, {1})",
    "+ PnD": "date_add({0}, {1})",
    "- PnD": "date_sub({0}, {1})",
    "+ PnW": "date_add({0}, 7 * {1})",
    "+ PnM": "add_months({0}, {1})",
    "+ PnY": "add_months({0}, 12 * {1})",
}

# Keywords of the two notations, day names, duration literals.
EXPRESSION_KEYWORDS = ("and", "or", "not", "in", "as", "true", "false", "null")
FEEL_KEYWORDS = (
    "if", "then", "else", "for", "in", "return", "and", "or", "true", "false", "null",
    "some", "every", "satisfies", "between", "instance", "of", "function",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DURATION = r"^P(\d+)[DWMY]$"


# How the two model formats write a day set around its day test.
DAY_SET_TEXT = {
    "expression": (
        'filter(map([0..d({to}, "UTC").add({pad}, "d").diff(d({from}, "UTC").sub({pad}, "d"), "day")],'
        ' d({from}, "UTC").sub({pad}, "d").add(#, "d").format("%Y-%m-%d")), {test})'
    ),
    "feel": (
        '(for i in 0..(date({to}) + duration("P{pad}D") - (date({from}) - duration("P{pad}D"))).days'
        ' return string(date({from}) - duration("P{pad}D") + duration("P1D") * i))[{test}]'
    ),
}


def spark_sql(name: str, *args: str, table: dict[str, str] = EXPRESSION_FUNCTIONS) -> str:
    """The Spark SQL text of one call. Arguments are SQL texts."""
    return "(" + table[name].format(*args) + ")"
