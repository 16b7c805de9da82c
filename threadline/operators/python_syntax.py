"""Python text to flat rows, inside tasks. No lineage rule lives here.

``statement_rows`` lists, in visiting order, each assignment to one name and each
call that may write, with the pieces the Spark rules look at.
"""

from __future__ import annotations

import ast
import textwrap

import pyarrow as pa

# Methods that end a write, register a view or run SQL.
SINK_METHODS = ("saveAsTable", "insertInto", "save", "createOrReplaceTempView", "sql")


def _hole(node: ast.AST) -> str:
    return "${" + ast.unparse(node) + "}"


#: What an expression's text is put together from, by kind of node: further nodes, texts, None where there is no text.
_PARTS = {
    ast.Constant: lambda n: [n.value if isinstance(n.value, str) else None],
    ast.BinOp: lambda n: [n.left, n.right] if isinstance(n.op, ast.Add) else [None],
    ast.JoinedStr: lambda n: n.values,
    ast.FormattedValue: lambda n: [_hole(n.value)],
    ast.Attribute: lambda n: [_hole(n)],
    ast.Subscript: lambda n: [_hole(n)],
}
STEP = pa.struct([("name", pa.string()), ("called", pa.bool_()), ("args", pa.list_(pa.string())), ("path_kw", pa.string())])
STATEMENT = pa.struct(
    [
        ("ord", pa.int32()),
        ("parent", pa.int32()),
        ("target", pa.string()),
        ("shape", pa.string()),
        ("base", pa.string()),
        ("base_args", pa.list_(pa.string())),
        ("steps", pa.list_(STEP)),
        ("names", pa.list_(pa.string())),
        ("later_names", pa.list_(pa.string())),
        ("union_of", pa.list_(pa.string())),
    ]
)
STATEMENT_DDL = (
    "array<struct<ord:int,parent:int,target:string,shape:string,base:string,base_args:array<string>,"
    "steps:array<struct<name:string,called:boolean,args:array<string>,path_kw:string>>,"
    "names:array<string>,later_names:array<string>,union_of:array<string>>>"
)


def symbol(node: ast.AST, bound: dict, asked: frozenset = frozenset()) -> str | None:
    """Text a node stands for; ``${...}`` where it cannot be known.

    Parts are taken apart from left to right until only texts remain. A name stands for
    what it was last bound to, unless that is what is being asked for already.
    """
    texts, todo = [], [node]
    while todo:
        part = todo.pop()
        if isinstance(part, ast.Name):
            own = None if part.id in asked else bound.get(part.id)
            texts.append((symbol(own, bound, asked | {part.id}) if own is not None else None) or _hole(part))
        elif isinstance(part, str):
            texts.append(part)
        elif type(part) in _PARTS:
            todo.extend(reversed(_PARTS[type(part)](part)))
        else:
            return None
    return "".join(texts)


def _is_remembered(value: ast.AST) -> bool:
    """Whether a name bound to the value can be looked up later: as a text, or as a list of frames."""
    return type(value) in _PARTS or isinstance(value, ast.Name | ast.List)


def _names(node: ast.AST | None) -> list[str]:
    found = [n.id for n in ast.walk(node) if isinstance(n, ast.Name)] if node is not None else []
    return list(dict.fromkeys(found))


def _chain(node: ast.AST, bound: dict) -> dict:
    """Method chain from its base outwards, walking through calls."""
    steps, call = [], None
    tail = []  # arguments of the chain, for names apart from the base call
    while True:
        if isinstance(node, ast.Attribute):
            own = {} if node.attr == "option" else bound
            keyword = next((k.value for k in call.keywords if k.arg == "path"), None) if call else None
            steps.append(
                {
                    "name": node.attr,
                    "called": call is not None,
                    "args": [symbol(a, own) for a in call.args] if call else [],
                    "path_kw": symbol(keyword, bound) if keyword is not None else None,
                }
            )
            if call:
                tail += [*call.args, *[k.value for k in call.keywords]]
            node, call = node.value, None
        elif isinstance(node, ast.Call) and call is None:
            node, call = node.func, node
        else:
            break
    direct = isinstance(node, ast.Name)
    return {
        "base": node.id if direct else None,
        "base_args": [symbol(a, bound) for a in call.args] if direct and call else None,
        "steps": steps[::-1],
        "later_names": list(dict.fromkeys(n for a in tail for n in _names(a))),
    }


def _union_members(value: ast.AST, bound: dict) -> list[str] | None:
    """Names in the list that ``reduce(DataFrame.union, ...)`` puts together; None for any other expression."""
    if not isinstance(value, ast.Call) or len(value.args) < 2 or ast.unparse(value.args[0]) != "DataFrame.union" or ast.unparse(value.func) != "reduce":
        return None
    frames = value.args[1]
    if isinstance(frames, ast.Name):
        frames = bound.get(frames.id)
    return [frame.id for frame in getattr(frames, "elts", []) if isinstance(frame, ast.Name)]


def statement_rows(tree: ast.AST, bound: dict, rows: list[dict]) -> None:
    """Append the rows of one tree; ``bound`` carries simple assignments between trees."""

    def visit(node: ast.AST, parent: int | None) -> None:
        inside = parent
        if isinstance(node, ast.Assign) and len(node.targets) == 1 and isinstance(node.targets[0], ast.Name):
            value, target = node.value, node.targets[0].id
            if _is_remembered(value):
                bound[target] = value
            shape = "call" if isinstance(value, ast.Call) else "attribute" if isinstance(value, ast.Attribute) else "other"
            inside = len(rows)
            rows.append(
                {"ord": inside, "parent": None, "target": target, "shape": shape, **_chain(value, bound),
                 "names": _names(value), "union_of": _union_members(value, bound)}
            )
        elif isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in SINK_METHODS:
            rows.append(
                {"ord": len(rows), "parent": parent, "target": None, "shape": "call", **_chain(node, bound),
                 "names": _names(node.func.value), "union_of": None}
            )
        for child in ast.iter_child_nodes(node):
            visit(child, inside)

    visit(tree, None)


def notebook_rows(source: str, units: list[dict]) -> tuple[list[dict], list[dict]]:
    """(statements, errors) of a notebook; cell by cell when the whole does not parse."""
    rows: list[dict] = []
    try:
        statement_rows(ast.parse(source), {}, rows)
        return rows, []
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        pass
    rows, errors, bound = [], [], {}
    for unit in units:
        try:
            lines = [x for x in (unit["text"] or "").splitlines() if not x.lstrip().startswith("%")]
            statement_rows(ast.parse(textwrap.dedent("\n".join(lines)).strip()), bound, rows)
        except (SyntaxError, ValueError, RecursionError, MemoryError) as error:
            errors.append({"cell_no": unit["cell_no"], "error": type(error).__name__})
    return rows, errors


def tree_rows(text: str) -> list[dict]:
    """Syntax tree nodes as (ast_id, parent_id, type, text, line, end_line)."""
    rows: list[dict] = []

    def visit(node: ast.AST, parent: int | None) -> None:
        own = len(rows)
        shown = getattr(node, "id", None) or getattr(node, "name", None) or getattr(node, "attr", None) or getattr(node, "arg", None)
        rows.append(
            {"ast_id": own, "parent_id": parent, "type": type(node).__name__, "text": shown if isinstance(shown, str) else None,
             "line": getattr(node, "lineno", None), "end_line": getattr(node, "end_lineno", None)}
        )
        for child in ast.iter_child_nodes(node):
            visit(child, own)

    visit(ast.parse(text), None)
    return rows


def chunk_rows(text: str) -> list[dict]:
    """The imports as one chunk, then one chunk per top-level function or class."""
    lines = text.splitlines()
    body = ast.parse(text).body

    def cut(node: ast.stmt) -> str:
        first = min([node.lineno, *[d.lineno for d in getattr(node, "decorator_list", [])]])
        return "\n".join(lines[first - 1 : node.end_lineno])

    imports = [cut(n) for n in body if isinstance(n, (ast.Import, ast.ImportFrom))]
    chunks = [{"kind": "imports", "name": None, "text": "\n".join(imports)}] if imports else []
    for node in body:
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            kind = "class" if isinstance(node, ast.ClassDef) else "function"
            chunks.append({"kind": kind, "name": node.name, "text": cut(node)})
    return [{"chunk_no": i, **chunk} for i, chunk in enumerate(chunks)]
