"""Saving fitted operators by Spark ML's own writers, so that a ``PipelineModel`` of them can be stored.

A model's metadata hold its parameters and what ``_state`` gives as JSON; tables go beside them.
"""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class StatefulWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        instance = self.instance
        DefaultParamsWriter.saveMetadata(instance, path, self.sparkSession, extraMetadata={"state": instance._state()})
        instance._save_tables(self.sparkSession, path)


class StatefulReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.kind._of_state(metadata["state"], self.sparkSession, path)
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


class Stateful(MLWritable, MLReadable):
    """A fitted model that says what of it is stored: ``_state``, ``_save_tables`` and ``_of_state``."""

    def write(self) -> StatefulWriter:
        return StatefulWriter(self)

    @classmethod
    def read(cls) -> StatefulReader:
        return StatefulReader(cls)

    def _state(self) -> dict:
        raise TypeError(f"{type(self).__name__} does not say what of it is stored")

    def _save_tables(self, spark, path: str) -> None:
        """Models whose state is all there is have no tables."""

    @classmethod
    def _of_state(cls, state: dict, spark, path: str):
        raise TypeError(f"{cls.__name__} does not say how it is read")
