"""The stateless steps on streams: they take the same expressions as the batch jobs."""
