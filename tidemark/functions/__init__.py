"""Column expressions. Everything here stays inside whole-stage codegen except
the two Arrow functions named in ``text`` and ``payload``."""
