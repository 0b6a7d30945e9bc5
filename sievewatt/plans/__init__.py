"""Jobs that chain operators: the layer runs, the risk model, the reports."""
