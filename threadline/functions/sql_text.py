"""SQL text as Spark SQL expressions: marks, clauses, names.

``split_statements`` reads a cell once and writes after every parenthesis, comma and
clause keyword the number of the parenthesis group it stands in, 0 outside any; a
group's own parentheses carry its number. A clause then ends at the next keyword with
its own number, and a query block is what lies between. Literals are put aside and
comments left out, so neither can be taken for SQL. Every other function returns the
text of a Spark SQL expression and takes such texts.
"""

from __future__ import annotations

import re

# Keywords that begin a clause.
_CLAUSES = (
    "SELECT", "FROM", "JOIN", "WHERE", "GROUP", "ORDER", "HAVING", "LIMIT", "UNION", "INTERSECT", "EXCEPT", "MINUS",
    "WITH", "WINDOW", "QUALIFY", "LATERAL", "CLUSTER", "DISTRIBUTE", "SORT", "ON", "USING",
)
# Keywords that end a FROM list, a WHERE condition, a GROUP BY or ORDER BY list.
_ENDS = "|".join(("WHERE", "GROUP", "ORDER", "HAVING", "LIMIT", "UNION", "INTERSECT", "EXCEPT", "MINUS", "WINDOW", "QUALIFY",
                  "LATERAL", "CLUSTER", "DISTRIBUTE", "SORT", "JOIN", "ON", "USING"))
_SET_OPERATORS = ("UNION", "INTERSECT", "EXCEPT", "MINUS")
_QUERIES = ("SELECT", "WITH", "VALUES", "FROM", "TABLE")
_FROM_CALLS = ("EXTRACT", "TRIM", "SUBSTRING", "SUBSTR", "OVERLAY", "POSITION")

_DEPTH = r"\x01(\d+)\x02"
_ANY_MARK = r"\x01\d+\x02"
_LITERAL = r"\x03(\d+)\x04"
WORD = r"(?:\$\{[^}]*+\}|\{\{.*?\}\}|[\p{L}\p{M}\p{N}_$])"
_PART = rf"(?:`[^`]+`|{WORD}++)"
NAME = rf"{_PART}(?:\.{_PART})*+"

_TOKEN = re.compile(
    r"""'(?:[^'\\]++|\\.|'')*+'|\"(?:[^\"\\]++|\\.)*+\"
    |--[^\n]*+|/\*.*?\*/|`[^`]*+`
    |(?:\$\{[^}]*+\}|\{\{.*?\}\}|[\w$.])++
    |\s++|.""",
    re.S | re.X,
)


def split_statements(content: str) -> tuple[list[tuple[str, list[str]]], bool]:
    """The statements of a cell as (marked text, literals), blank ones left out, and whether its parentheses match.

    Parentheses around the tables of a join or the operand of a set operation are no
    query of their own and are left out. One pass over the text and one over its tokens.
    """
    tokens = [t for t in _TOKEN.findall(re.sub("[\x01-\x04]", " ", content)) if not t.startswith(("--", "/*"))]
    shown = [i for i, t in enumerate(tokens) if not t.isspace()]
    after = dict(zip(shown, shown[1:], strict=False))
    word = lambda i: tokens[i].upper() if i is not None else ""
    closes, opened, balanced = {}, [], True
    for i in shown:
        if tokens[i] == "(":
            opened.append(i)
        elif tokens[i] == ")" and opened:
            closes[opened.pop()] = i
        elif tokens[i] == ")":
            balanced = False
    balanced = balanced and not opened

    def joined(i: int) -> bool:
        """Whether the parenthesis at i, in a FROM list, holds tables that are joined rather than a query."""
        first = after.get(i)
        if first is not None and tokens[first] == "(":
            behind = word(after.get(closes.get(first)))
            return behind not in (*_SET_OPERATORS, ")", "")
        return word(first) not in _QUERIES

    found: list[tuple[str, list[str]]] = []
    text, literals = [], []
    groups, clauses, hidden, numbers, before = [0], [""], [], 0, ""
    for i, token in enumerate(tokens):
        upper = token.upper()
        if token.isspace():
            text.append(token)
            continue
        group = groups[-1]
        if token[0] in "'\"" and len(token) > 1:
            text.append(f"\x03{len(literals)}\x04")
            literals.append(token)
        elif token == "(":
            in_list = before in ("FROM", "JOIN") or (before == "," and clauses[-1] in ("FROM", "ON", "USING"))
            operand = before in ("", "(", *_SET_OPERATORS) and word(after.get(i)) in ("SELECT", "WITH", "(")
            if (in_list and joined(i)) or (operand and not in_list):
                hidden.append(True)
                text.append(" ")
                continue
            hidden.append(False)
            numbers += 1
            groups.append(numbers)
            clauses.append("CALL" if before in _FROM_CALLS else "")
            text.append(f"(\x01{numbers}\x02")
        elif token == ")":
            if hidden and not hidden.pop():
                text.append(f")\x01{groups.pop()}\x02")
                clauses.pop()
            else:
                text.append(" ")
        elif token == ";" and group == 0 and len(groups) == 1:
            found.append(("".join(text), literals))
            text, literals, clauses, before = [], [], [""], ""
            continue
        elif token in (",", ";"):
            text.append(f"{token}\x01{group}\x02")
        elif upper == "FROM" and (clauses[-1] == "CALL" or before == "DISTINCT"):
            text.append(token)  # of EXTRACT(x FROM y) and its like, of IS DISTINCT FROM
        elif upper in _CLAUSES and (upper not in _SET_OPERATORS or _set_follows(tokens, after, i)):
            text.append(f"{token}\x01{group}\x02")
            clauses[-1] = upper
        else:
            text.append(token)
        if upper not in ("ALL", "DISTINCT") or before not in _SET_OPERATORS:
            before = upper
    found.append(("".join(text), literals))
    return [(t, x) for t, x in found if re.sub("[\x01-\x04\\d\\s]", "", t) or x], balanced


def _set_follows(tokens: list[str], after: dict[int, int], i: int) -> bool:
    """Whether a parenthesis after a set operator's word holds a query: ``* EXCEPT (a)`` has names in it."""
    at = after.get(i)
    while at is not None and tokens[at] == "(":
        at = after.get(at)
    return at is not None and tokens[at].upper() in (*_QUERIES, "ALL", "DISTINCT")


def _raw(pattern: str) -> str:
    """A pattern as a raw Spark SQL literal."""
    return 'r"' + pattern.replace('\\"', '"').replace('"', r"\x22") + '"'


def literal_at(literals: str, number: str) -> str:
    """Text of a literal without its quotes."""
    return f"regexp_replace(get({literals}, CAST({number} AS INT)), {_raw('^.|.$')}, '')"


def unmasked(text: str, literals: str = "literals") -> str:
    """The text with its literals put back."""
    piece = f"concat(get({literals}, CAST(substring_index(p, '\\u0004', 1) AS INT)), substr(p, instr(p, '\\u0004') + 1))"
    return f"if(contains({text}, '\\u0003'), array_join(transform(split({text}, '\\u0003'), (p, i) -> if(i = 0, p, {piece})), ''), {text})"


def plain(text: str) -> str:
    """The text without marks and outer blanks."""
    return f"regexp_replace(regexp_replace({text}, {_raw(_ANY_MARK)}, ''), {_raw(chr(94) + r'\s+|\s+$')}, '')"


def extract(text: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({text}, {_raw('(?is)' + pattern)}, {group}), '')"


def extract_all(text: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({text}, {_raw('(?is)' + pattern)}, {group})"


def clean_name(name: str) -> str:
    return f"replace({name}, '`', '')"


_END = rf"(?:\b(?:{_ENDS})\x01\1\x02|\)\x01\1\x02|$)"


def from_lists(text: str) -> str:
    """Text of every FROM list, nested ones too."""
    return extract_all(text, rf"\bFROM{_DEPTH}(?=(.*?){_END})", 2)


def collapsed(text: str) -> str:
    """Text with each outermost parenthesis group emptied."""
    return f"regexp_replace({text}, {_raw(rf'(?s)\({_DEPTH}.*?\)\x01\1\x02')}, '()')"


# Statements that name a table without FROM.
_NAMED = (
    r"^\s*(?:UPDATE|TRUNCATE\s+TABLE|DROP\s+(?:TABLE|VIEW)(?:\s+IF\s+EXISTS)?|ALTER\s+(?:TABLE|VIEW))\s+"
)


def tables_in(text: str) -> str:
    """Names after FROM, in its comma lists, after JOIN and after UPDATE and its like; functions and subqueries left out."""
    item = rf"^\s*({NAME})(?!\s*\()"
    listed = (
        f"flatten(transform({from_lists(text)}, f -> transform(split({collapsed('f')}, {_raw(',' + _ANY_MARK)}), i -> {extract('i', item)})))"
    )
    joined = extract_all(text, rf"\bJOIN{_ANY_MARK}\s*({NAME})(?!\s*\()", 1)
    named = extract(text, rf"{_NAMED}({NAME})")
    return f"transform(filter(concat({listed}, {joined}, array({named})), n -> n IS NOT NULL), n -> {clean_name('n')})"


def sorted_tables_in(text: str) -> str:
    return f"array_sort(array_distinct({tables_in(text)}))"


def functions_in_from(text: str) -> str:
    """Functions called in FROM lists, in order, each once."""
    call = rf"({NAME})\s*\({_ANY_MARK}"
    words = "upper(n) NOT IN ('AS', 'IN', 'ON', 'AND', 'OR', 'NOT', 'VALUES', 'EXISTS')"
    return f"array_distinct(filter(flatten(transform({from_lists(text)}, f -> {extract_all('f', call)})), n -> {words}))"


_CTE_HEAD = rf"(?:\bWITH{_ANY_MARK}(?:\s+RECURSIVE\b)?|,{_ANY_MARK})\s*({NAME})\s*(?:\({_ANY_MARK}([^()]*)\){_ANY_MARK}\s*)?AS\s*\({_DEPTH}"
_CTE = rf"{_CTE_HEAD}\s*(?:SELECT|WITH)\b.*?\)\x01\3\x02"
_CTE_AHEAD = rf"{_CTE_HEAD}(?=(\s*(?:SELECT|WITH)\b.*?)\)\x01\3\x02)"


def ctes(text: str) -> str:
    """array of struct(name, columns, number, body) of the common table expressions, nested ones too.

    ``columns`` is the text of a list of column names, ``number`` the group of the body.
    """
    parts = [extract_all(text, _CTE_AHEAD, g) for g in (1, 2, 3, 4)]
    name = clean_name("z['0']")
    return f"transform(arrays_zip({', '.join(parts)}), z -> struct({name} AS name, z['1'] AS columns, z['2'] AS number, z['3'] AS body))"


def without_ctes(text: str) -> str:
    return f"regexp_replace({text}, {_raw('(?is)' + _CTE)}, '')"


TARGET = (
    r"\b(?:CREATE\s+(?:OR\s+REPLACE\s+)?(?:GLOBAL\s+)?(?:TEMP\s+|TEMPORARY\s+)?(?:EXTERNAL\s+)?(?:MATERIALIZED\s+)?(?:TABLE|VIEW)(?:\s+IF\s+NOT\s+EXISTS)?"
    r"|INSERT\s+(?:INTO|OVERWRITE)(?:\s+TABLE)?|REPLACE\s+(?:INTO|TABLE))\s+"
)


_START = rf"^\s*(?:FROM{_ANY_MARK}.*?\b)??"
_DIRECTORY = r"(?:LOCAL\s+)?DIRECTORY\b"


def target(main: str) -> str:
    """Table or view the statement creates, replaces or inserts into; ``main`` is without CTEs."""
    return clean_name(extract(main, rf"{_START}{TARGET}(?!{_DIRECTORY})({NAME})"))


def path_target(main: str, literals: str = "literals") -> str:
    """Path of the directory the statement writes."""
    return literal_at(literals, extract(main, rf"{_START}INSERT\s+OVERWRITE\s+{_DIRECTORY}\s*{_LITERAL}"))


def merge_target(main: str) -> str:
    return clean_name(extract(main, rf"^\s*MERGE\s+INTO\s+({NAME})"))


def merge_sources(text: str) -> str:
    """The USING table, or the tables of the USING query."""
    direct = clean_name(extract(text, rf"\bUSING{_ANY_MARK}\s*({NAME})"))
    return f"if({direct} IS NOT NULL, array({direct}), {sorted_tables_in(text)})"


def aggregations(text: str) -> str:
    """array of struct(function, argument, distinct); the flag is only told for COUNT."""
    head = rf"\b(MAX|MIN|SUM|AVG|COUNT)\s*\({_DEPTH}(?=(.*?)\)\x01\2\x02)"
    flag = _raw(r"(?is)^\s*DISTINCT\b\s*")
    return (
        f"zip_with({extract_all(text, head, 1)}, {extract_all(text, head, 3)}, (f, a) -> struct(upper(f) AS function, "
        f"{unmasked(plain(f'regexp_replace(a, {flag}, chr(32))'))} AS argument, (upper(f) = 'COUNT' AND a RLIKE {flag}) AS distinct))"
    )


_MAIN = rf"^.*?\bSELECT{_DEPTH}"


def depth_of_select(text: str) -> str:
    return extract(text, _MAIN, 1)


def filters(text: str) -> str:
    """Conditions of the WHERE clauses that belong to the first SELECT."""
    clause = rf"{_MAIN}.*?\bWHERE\x01\1\x02(.*?){_END}"
    return f"filter(array({unmasked(plain(extract(text, clause, 2)))}), f -> f IS NOT NULL)"


def _items(text: str, keyword: str) -> str:
    clause = rf"{_MAIN}.*?\b{keyword}\x01\1\x02\s+BY\b(.*?){_END}"
    whole = extract(text, clause, 2)
    comma = rf"concat(',\\x01', {depth_of_select(text)}, '\\x02')"
    return f"coalesce(transform(split({whole}, {comma}), i -> {unmasked(plain('i'))}), CAST(array() AS array<string>))"


def group_by(text: str) -> str:
    return _items(text, "GROUP")


def order_by(text: str) -> str:
    return _items(text, "ORDER")


def final_from(text: str) -> str:
    """FROM list of the first SELECT, as marked text that starts with FROM."""
    clause = rf"{_MAIN}.*?\b(FROM\x01\1\x02.*?){_END}"
    return extract(text, clause, 2)


def numbered(pattern: str) -> str:
    """A pattern in which ``%g`` stands for the number in the column ``number``, as an expression."""
    return f"concat({', number, '.join(_raw(part) for part in ('(?is)' + pattern).split('%g'))})"


_BLOCK = rf"\bSELECT{_DEPTH}(?=(.*?)(?:\)\x01\1\x02|\b(?:UNION|INTERSECT|EXCEPT|MINUS)\x01\1\x02|$))"


def blocks(text: str) -> str:
    """array of struct(number, body): every SELECT of the statement, in order, with its group's number."""
    return f"zip_with({extract_all(text, _BLOCK, 1)}, {extract_all(text, _BLOCK, 2)}, (n, b) -> struct(n AS number, b AS body))"


def block_items(body: str = "body") -> str:
    """Texts of a block's select list; needs the column ``number``."""
    listed = f"regexp_extract({body}, {numbered(rf'^{chr(92)}s*(?:DISTINCT{chr(92)}b|ALL{chr(92)}b)?(.*?)(?:{chr(92)}bFROM{chr(92)}x01%g{chr(92)}x02|$)')}, 1)"
    return f"split({listed}, concat(',\\u0001', number, '\\u0002'))"


def block_sources(body: str = "body") -> str:
    """Texts of what a block reads, one for each entry of its FROM list and each JOIN; needs ``number``."""
    end = rf"(?:\b(?:{_ENDS})\x01%g\x02|$)"
    listed = f"regexp_extract({body}, {numbered(rf'{chr(92)}bFROM{chr(92)}x01%g{chr(92)}x02(.*?){end}')}, 1)"
    joins = f"regexp_extract_all({body}, {numbered(rf'{chr(92)}bJOIN{chr(92)}x01%g{chr(92)}x02(?=(.*?){end})')}, 1)"
    return f"concat(split({listed}, concat(',\\u0001', number, '\\u0002')), {joins})"
