"""DataFrame-in, DataFrame-out steps; each works on batch and streaming frames."""
