"""DataFrame operators: the gate, daily metrics, checks, reliability, previews."""
