"""DataFrame -> DataFrame steps. Lazy, unless a docstring says otherwise."""
