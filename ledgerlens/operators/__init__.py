"""DataFrame-in / DataFrame-out operators, one module per part of the build."""
