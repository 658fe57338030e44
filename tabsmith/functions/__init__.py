"""Column-expression helpers (JVM-side, codegen-friendly)."""

from tabsmith.functions.keyed import keyed_normal, keyed_uniform
from tabsmith.functions.parse import null_tokens, safe_double, strip_blanks

__all__ = ["keyed_uniform", "keyed_normal", "safe_double", "strip_blanks", "null_tokens"]
