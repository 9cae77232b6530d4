"""workpulse: work-item health analytics as Spark DataFrame operators.

Stages are pure ``DataFrame -> DataFrame`` functions; one ``as_of`` timestamp
and one :class:`~workpulse.params.Params` object drive every run.
"""

from workpulse.params import Params

__all__ = ["Params"]
