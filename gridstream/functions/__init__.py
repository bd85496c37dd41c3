"""Column builders: row rules that stay inside whole-stage codegen."""

from gridstream.functions.rules import *  # noqa: F401,F403
