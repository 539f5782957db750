"""Errors by where they come from; each carries a code that can be reported."""

from __future__ import annotations


class PressError(Exception):
    code = "PRESS"

    def __init__(self, message: str = "", code: str | None = None, status: int | None = None) -> None:
        super().__init__(message or code or self.code)
        self.code, self.status = code or self.code, status


class ValidationError(PressError, ValueError):
    """Data that breaks a rule."""

    code = "VALIDATION"


class FetchError(PressError):
    """A source that could not be fetched: NETWORK, HTTP_STATUS, INVALID_JSON, FETCH."""

    code = "FETCH"


class AnswerError(PressError):
    """A model call that failed; `status` is the HTTP status, if there was one."""

    code = "AI"


class StageError(PressError):
    """A stage of a run that ended with a diagnostic."""

    code = "pipeline_failed"
