"""Print the query names registered by the given catalog modules."""

import ast
import sys
from pathlib import Path

for module in sys.argv[1:]:
    tree = ast.parse((Path(__file__).parent.parent / "catalog" / f"{module}.py").read_text())
    print(*[n.name.rstrip("_") for n in tree.body if isinstance(n, ast.FunctionDef) and n.decorator_list])
