"""Signatures of licence bodies and notices: sentences by which a text shows its terms without naming them.

Written by hand, one sentence each: label and words as a pattern. Words are
lower-cased and stand without marks, as the scan cuts them, so ``AS IS`` in quotes is ``as is``. A sentence is
gated by the first of ``KEYWORDS`` that it holds in any case, or else by its longest fixed stretch.
"""

from __future__ import annotations

#: Stems that gate most sentences, so that a text is searched for few of them.
KEYWORDS = [
    "public domain", "permission", "redistribut", "merchantab", "warrant", "patent", "reserv", "free software", "source code",
    "copyright", "contribut", "proprietary", "derivative", "database", "reproduc", "distribut", "licen", "software", "notice",
]

# Label and words.
BODIES = [
    # Permissive bodies.
    ("mit", "to deal in the software without restriction including without limitation the rights"),
    ("mit", "to use copy modify merge publish distribute sublicen[sc]e and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[sc]e and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("json", "the software shall be used for good not evil"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "the author disclaims all warranties with regard to this software"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("hpnd", "that the name of \\S+(?: \\S+){0,4} not be used in advertising or publicity pertaining to distribution"),
    ("ntp", "the name of \\S+(?: \\S+){0,4} may not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    ("x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd", "this software is provided by the (?:copyright holders and contributors|author|regents and contributors) as is and any express or implied warranties"),
    ("bsd", "in no event shall the (?:copyright (?:holder|owner)|author|regents)(?: or contributors)? be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-3-clause", "neither the name of \\S+(?: \\S+){0,8} nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
    ("bsd-2-clause-views", "the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"),
    ("bsd-3-clause-clear", "no express or implied licen[sc]es to any party s patent rights are granted by this licen[sc]e"),
    ("bsd-patent", "hereby grants to those receiving rights under this licen[sc]e a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("bsl-1.0", "to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software"),
    ("bsl-1.0", "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("ncsa", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("w3c", "by obtaining (?:using and or copying )?this work you the licen[sc]ee agree that you have read understood and will comply"),
    ("icu", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("unicode", "data files and any associated documentation the data files or unicode software"),
    ("naist", "use reproduction and distribution of this software is permitted any copy of this software"),
    ("libtiff", "permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee"),
    ("libpng", "permission is hereby granted to use copy modify and distribute this source code or portions hereof for any purpose without fee"),
    ("ijg", "the accompanying documentation must state that this software is based in part on the work of the independent jpeg group"),
    ("freetype", "portions of this software are copyright \\S+(?: \\S+)? the freetype project"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "this product includes cryptographic software written by eric young"),
    ("apache-1.1", "this product includes software developed by the apache software foundation"),
    ("php", "this product includes php software freely available from"),
    ("python", "the psf is making python available to licen[sc]ee on an as is basis"),
    ("python", "this licen[sc]e agreement is between the python software foundation psf and the individual or organization"),
    ("vim", "vim is charityware you can use and copy it as much as you like"),
    ("imagemagick", "a copy of the licen[sc]e is available at imagemagick"),
    ("info-zip", "redistributions in binary form compiled executables must reproduce the above copyright notice definition disclaimer"),
    ("tcl", "the authors hereby grant permission to use copy modify distribute and licen[sc]e this software and its documentation for any purpose"),
    ("fair", "usage of the works is permitted provided that this instrument is retained with the works"),
    ("xfree86", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    # Dedications.
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest"),
    ("wtfpl", "you just do what the f\\S+ you want to"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving"),
    ("cc0-1.0", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("cc0-1.0", "to the extent possible under law \\S+(?: \\S+){0,6} has waived all copyright and related or neighboring rights"),
    ("pddl", "the dedicator hereby dedicates the work to the public domain"),
    ("public-domain", "this (?:file|work|software|document|program|code|text) (?:is|was|has been) (?:put |placed |released )?(?:in|into) the public domain"),
    ("public-domain", "i the copyright holder of this work (?:hereby )?release (?:it|this work) into the public domain"),
    ("public-domain", "no copyright is claimed and no rights are reserved"),
    ("public-domain", "works of the united states government are not subject to copyright"),
    ("sqlite-blessing", "may you do good and not evil may you find forgiveness for yourself and forgive others"),
    # Apache.
    ("apache-2.0", "you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) licen[sc]e"),
    ("apache-2.0", "you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-2.0", "licen[sc]or shall mean the copyright owner or entity authorized by the copyright owner that is granting the licen[sc]e"),
    ("apache-2.0", "if the work includes a notice text file as part of its distribution"),
    ("apache-2.0", "licen[sc]ed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("ecl-2.0", "educational community licen[sc]e version 2 0 the ecl"),
    # Copyleft families.
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e along with this program"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("gpl", "the licen[sc]es for most software are designed to take away your freedom to share and change it"),
    ("gpl", "when we speak of free software we are referring to freedom not price"),
    ("gpl", "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed"),
    ("gpl-2.0", "a work based on the program means either the program or any derivative work under copyright law"),
    ("gpl-2.0", "you must cause the modified files to carry prominent notices stating that you changed the files and the date of any change"),
    ("gpl-2.0", "mere aggregation of another work not based on the program with the program"),
    ("gpl-3.0", "to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gpl-3.0", "to convey a work means any kind of propagation that enables other parties to make or receive copies"),
    ("gpl-3.0", "a user product is either 1 a consumer product which means any tangible personal property"),
    ("gpl-3.0", "protecting users legal rights from anti circumvention law"),
    ("gpl-exception-classpath", "as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gpl-exception-linking", "as a special exception \\S+(?: \\S+){0,8} permission to link"),
    ("gpl-exception-bison", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-exception-openssl", "in addition as a special exception the copyright holders give permission to link the code of portions of this program with the openssl library"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public"),
    ("lgpl", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library by being compiled or linked with it"),
    ("lgpl-3.0", "a combined work is a work produced by combining or linking an application with the library"),
    ("agpl-3.0", "must prominently offer all users interacting with it remotely through a computer network"),
    ("agpl-3.0", "the gnu affero general public licen[sc]e is designed specifically to ensure that in such cases the modified source code becomes available"),
    ("agpl", "under the terms of the gnu affero general public licen[sc]e as published by the free software foundation"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "with the invariant sections being list their titles"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one"),
    ("mpl-2.0", "this source code form is incompatible with secondary licen[sc]es"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("mpl-1.1", "the initial developer of the original code is"),
    ("mpl-1.1", "alternatively the contents of this file may be used under the terms of either the gnu general public"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public"),
    ("epl", "the accompanying program is provided under the terms of this eclipse public licen[sc]e"),
    ("cpl-1.0", "the accompanying program is provided under the terms of this common public licen[sc]e"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution"),
    ("cddl", "when distributing (?:covered code|the software) include this cddl header notice in each file"),
    ("eupl", "licen[sc]ed under the eupl"),
    ("osl", "licen[sc]ed under the open software licen[sc]e version"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "you may make and give away verbatim copies of the source form of the standard version of this package"),
    ("artistic-2.0", "this licen[sc]e establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("qpl", "you may distribute machine executable forms of the software or machine executable forms of modified versions"),
    ("lppl", "this work may be distributed and or modified under the conditions of the latex project public licen[sc]e"),
    ("lppl", "this work has the lppl maintenance status"),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices"),
    ("ms-pl", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software"),
    ("cecill", "ce logiciel est r[eé]gi par la licen[sc]e cecill"),
    ("cecill", "this software is governed by the cecill(?: [bc])? licen[sc]e under french law"),
    ("ofl-1.1", "this font software is licen[sc]ed under the sil open font licen[sc]e"),
    ("ofl-1.1", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("ofl-1.1", "no modified version of the font software may use the reserved font name"),
    ("bitstream-vera", "the font software may be modified altered or added to"),
    # Creative Commons and data.
    ("cc-by", "this work is licen[sc]ed under a creative commons attribution"),
    ("cc", "creative commons corporation is not a law firm and does not provide legal services"),
    ("cc", "by exercising the licen[sc]ed rights defined below you accept and agree to be bound by the terms and conditions"),
    ("cc-by", "you must give appropriate credit provide a link to the licen[sc]e and indicate if changes were made"),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same licen[sc]e"),
    ("cc-by-nc", "you may not use the material for commercial purposes"),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("odbl", "any rights in individual contents of the database are licen[sc]ed under the database contents"),
    ("odbl", "this \\S+(?: \\S+){0,4} is made available under the open database licen[sc]e"),
    ("odc-by", "is made available under the open data commons attribution licen[sc]e"),
    ("ogl-uk", "contains public sector information licen[sc]ed under the open government licen[sc]e"),
    ("dl-de", "datenlizenz deutschland (?:namensnennung|zero)"),
    ("etalab", "licence ouverte(?: open licence)?"),
    # Source that is available, and closed terms.
    ("busl-1.1", "the licen[sc]or hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licen[sc]ed work"),
    ("busl-1.1", "effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "the grant of rights under the licen[sc]e will not include and the licen[sc]e does not grant to you the right to sell the software"),
    ("polyform-noncommercial", "any noncommercial purpose is a permitted purpose"),
    ("polyform-small", "use of the software for the benefit of your company is use for a permitted purpose if your company has fewer than 100 total individuals"),
    ("confluent", "excluded purpose means making available any software as a service"),
    ("rail", "use based restrictions as referenced in paragraph 5 must be included as an enforceable provision"),
    ("llama", "\\S+ (?:\\S+ )?community licen[sc]e agreement by clicking i accept below or by using or distributing any portion"),
    ("proprietary", "this (?:document|file|software|material) (?:contains|is) (?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: \\S+){0,6} is (?:strictly )?prohibited"),
    ("proprietary", "no part of this (?:publication|book|document|work|file|website) may be reproduced"),
    ("proprietary", "without (?:the )?(?:express )?prior written (?:permission|consent) of"),
    ("proprietary", "contains trade secrets? and (?:proprietary|confidential) information"),
    ("proprietary", "you (?:may|shall) not (?:decompile|reverse engineer|disassemble)"),
    ("proprietary", "end user licen[sc]e agreement"),
    ("proprietary", "the software is licen[sc]ed not sold"),
    ("proprietary", "for (?:internal )?evaluation (?:purposes|use) only"),
    ("proprietary", "for personal (?:and )?non ?commercial use only"),
    ("proprietary", "commercial use (?:is )?(?:strictly )?(?:prohibited|forbidden|not permitted)"),
    ("proprietary", "use duplication or disclosure by the (?:u s )?government is subject to restrictions"),
    ("proprietary", "(?:is|are|remains?) the (?:sole )?(?:intellectual )?property of (?:its|their|the) respective owners?"),
    ("proprietary", "may not be (?:published broadcast rewritten|reproduced|copied)(?: or| and)? redistributed"),
    ("proprietary", "by (?:using|accessing) this (?:site|website|service) you agree to (?:be bound by )?(?:the |these |our )?terms of (?:use|service)"),
    ("ai-training-reserved", "text and data mining (?:is|are) (?:expressly )?(?:reserved|prohibited|not permitted)"),
    ("ai-training-reserved", "may not be used (?:to train|for training)(?: \\S+){0,4} (?:machine learning|artificial intelligence|language models?)"),
    # Notices in other languages.
    ("reserved", "alle rechte vorbehalten"),
    ("reserved", "tous droits r[eé]serv[eé]s"),
    ("reserved", "(?:todos|reservados todos) los derechos(?: reservados)?"),
    ("reserved", "tutti i diritti riservati"),
    ("reserved", "todos os direitos reservados"),
    ("proprietary", "vervielf[aä]ltigung(?: \\S+){0,6} nur mit (?:schriftlicher )?genehmigung"),
    ("proprietary", "(?:urheberrechtlich gesch[uü]tzt|durch das urheberrecht gesch[uü]tzt)"),
    ("proprietary", "(?:toute )?reproduction(?: m[eê]me partielle| totale ou partielle)? (?:est )?(?:interdite|strictement interdite)"),
    ("proprietary", "(?:queda )?prohibida (?:la|su) reproducci[oó]n(?: total o parcial)?"),
    ("cc-by", "creative commons namensnennung"),
    ("cc-by", "creative commons (?:reconocimiento|atribuci[oó]n)"),
    ("cc-by", "creative commons (?:paternit[eé]|attribution)"),
    ("public-domain", "(?:ist )?gemeinfrei"),
    ("public-domain", "(?:dans le )?domaine public"),
    ("public-domain", "(?:de )?dominio p[uú]blico"),
    ("gpl", "dieses programm ist freie software"),
    ("gpl", "ce programme est un logiciel libre"),
    ("gpl", "este programa es software libre"),
    # Contributions and headers.
    ("dco", "by making a contribution to this project i certify that"),
    ("cla", "contributor licen[sc]e agreement"),
    ("copyright", "copyright(?: c)? (?:19|20)[0-9]{2} (?:to )?(?:present|the \\S+ authors)"),
    ("license-mention", "see (?:the )?(?:licen[sc]e|copying|notice)(?: file| txt| md)? for (?:the )?(?:full |more )?(?:licen[sc]e )?(?:details|text|information|terms)"),
    ("license-mention", "(?:that can be |which can be )?found in the licen[sc]e file"),
    ("license-mention", "use of this source code is governed by (?:a|an) \\S+(?: style)? licen[sc]e"),
    ("license-mention", "(?:dual|multi) licen[sc]ed under"),
    ("license-mention", "licen[sc]ed under either of(?: \\S+){1,12} at your option"),
]
