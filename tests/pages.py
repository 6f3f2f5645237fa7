"""Hand-written pages."""


def cell(name, text):
    return f'<td class="{name}">{text}</td>'


def line(verb=None, pronoun=None, refl=None, aux=None):
    parts = []
    if pronoun is not None:
        parts.append(f'<td class="conj_pers-pron"><span class="conj_pp">{pronoun}</span></td>')
    if refl is not None:
        parts.append(cell("conj_refl-pron", refl))
    if aux is not None:
        parts.append(cell("conj_auxil", aux))
    if verb is not None:
        parts.append(cell("conj_verb", verb))
    return '<tr class="conj_line">' + "".join(parts) + "</tr>"


def tense(title, *lines):
    return f'<div class="tense"><h4 class="relation">{title}</h4><table>{"".join(lines)}</table></div>'


def mood(div_id, *tenses):
    return f'<div class="time" id="{div_id}"><div class="grid">{"".join(tenses)}</div></div>'


def voice(div_id, *moods):
    return f'<div id="{div_id}">{"".join(moods)}</div>'


def page(verb_id, *parts):
    return f'<div id="{verb_id}">{"".join(parts)}</div>'


def alternative(text):
    return f'<span class="or"> ou </span>{text}'


def reform(text):
    return f'<span class="or"> ou </span><span class="forme_rectif">{text}</span>'
