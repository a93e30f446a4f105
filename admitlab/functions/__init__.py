"""admitlab.functions."""
