"""Print the query names registered by one module: ``names.py regions``."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rooftally.queries import QUERIES  # noqa: E402

print(" ".join(n for n, f in QUERIES.items() if f.__module__.endswith("." + sys.argv[1])))
