"""One cleaning plan per dataset, the graph projection, and the run that builds the silver layer."""
