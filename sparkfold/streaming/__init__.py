"""Applying fitted steps to streaming input.

The reference reads whole files only and has no streaming operator, so
nothing here is new semantics: every ``apply_*`` step joins a *static*
statistics table onto its input, which Structured Streaming runs as a
stream-static join, so a model's encoders and imputers can score a
``readStream`` source unchanged.
"""

from sparkfold.streaming.apply import apply_steps, score_stream

__all__ = ["apply_steps", "score_stream"]
