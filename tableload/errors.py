class ContractError(ValueError):
    """A table contract cannot be loaded; raised before anything is written."""


class IncompleteStagingError(RuntimeError):
    """A staged table of the load was not fully written; the merge refuses to publish."""


class DuplicateRootError(RuntimeError):
    """A nested upsert received more than one root row per primary key."""


class DestructiveRefreshRefused(ValueError):
    """A destructive refresh was requested without the explicit opt-in."""


class TableNotFound(LookupError):
    """The dataset has no such table."""


class DamagedLedgerError(RuntimeError):
    """The newest commit of a dataset cannot be read."""
