"""admitlab.operators."""
