"""Shared base of the custom pipeline stages."""

from __future__ import annotations

from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class Configured(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Params given as keyword arguments; every param is listed in ``OPTIONS`` with its default.

    Values are plain numbers, strings, lists and dicts, so stages save and load
    with the standard params writer.
    """

    OPTIONS: dict = {}

    def __init__(self, **options):
        super().__init__()
        unknown = set(options) - set(self.OPTIONS)
        if unknown:
            raise TypeError(f"unknown options {sorted(unknown)}")
        for name, default in self.OPTIONS.items():
            setattr(self, name, Param(self, name, name))
            if default is not None:
                self._setDefault(**{name: default})
        given = {k: v for k, v in options.items() if v is not None}
        if given:
            self._set(**given)

    def value(self, name: str):
        param = self.getParam(name)
        return self.getOrDefault(param) if self.isDefined(param) else None
