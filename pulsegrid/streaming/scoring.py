"""Topic to scored documents, as a stream."""

from ..operators.enrich import enrich
from ..operators.messages import decode
from ..operators.monitor import with_event_time
from ..operators.quarantine import quarantined
from ..plans.scoring import score, score_enriched
from ..session import stored_meanwhile
from .commits import Committed
from .delivery import deliver, document_id, start_append, start_foreach_batch


def start_scoring(envelope, model, fmt, checkpoint, options=None, path=None, trigger=None):
    """Scored documents to an append sink. Map-only: no shuffle and no state."""
    return start_append(score(decode(envelope), model), fmt, checkpoint, options, path, trigger)


def start_quarantine(envelope, path, checkpoint, fmt="parquet", trigger=None):
    """The rows the scoring query leaves out, with a reason, as a query of its own."""
    return start_append(quarantined(enrich(decode(envelope))), fmt, checkpoint, None, path, trigger)


def scored_writer(model, write, quarantine):
    """``write(batch, batch_id, part)`` of topic rows: scored documents to ``write``, the others to ``quarantine`` with a reason.

    Rows are decoded and enriched once and stored for the two passes.
    """
    def both(batch, batch_id, part=""):
        with stored_meanwhile(enrich(decode(batch)), "batch") as rows:
            write(document_id(with_event_time(score_enriched(rows, model))), batch_id, part)
            quarantine(quarantined(rows), batch_id, part)

    return both


def start_scoring_job(envelope, model, write, quarantine, dead_letters, checkpoint, trigger=None):
    """Each batch read once: scored documents to ``write(rows, batch_id, part)``, the others to the ``quarantine`` table.

    Documents carry ``document_id`` and the parsed time, ``event_ts``. A batch that is repeated after a restart is not written twice
    to ``quarantine``, nor to a ``Committed`` sink; records that cannot be written go to ``dead_letters``, as they came.
    """
    both = scored_writer(model, write, Committed(quarantine))
    return start_foreach_batch(envelope, deliver(both, dead_letters), checkpoint, trigger=trigger)
