"""Typed errors."""

from __future__ import annotations


class LoomError(Exception):
    """Base class of everything this library raises on purpose."""


class ConfigError(LoomError, ValueError):
    """A model, source or operator was declared in a way that cannot work."""


class ResultError(LoomError):
    """User code returned something that does not fit the declared schema."""


class ModelError(LoomError):
    """A model failed; the message names it and the cause is chained."""

    def __init__(self, model: str, cause: object) -> None:
        super().__init__(f"model `{model}` failed: {cause}")
        self.model = model


class ModelTimeout(ModelError):
    """A model ran past its time limit and its Spark jobs were cancelled."""

    def __init__(self, model: str, seconds: float) -> None:
        super().__init__(model, f"no result within {seconds:g} s, jobs cancelled")
        self.seconds = seconds
